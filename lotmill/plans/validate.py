"""All quality checks in order, collected into report entries, JSON and text."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotmill import rules
from lotmill.operators import copies, forest, quality


def _entry(check: str, issues: list[str], stats: Mapping, passed: bool | None = None) -> dict:
    return {
        "timestamp": datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S"), "check_type": check,
        "passed": not issues if passed is None else passed, "issues": issues, "stats": dict(stats),
    }


def _by_column(table: DataFrame) -> dict[str, dict]:
    """Tables collected here have one row per column (or per check), never per data row."""
    return {r["column"]: {k: v for k, v in r.asDict().items() if k != "column"} for r in table.collect()}


class Validator:
    """Runs the checks on one table; every result is also kept as a report entry."""

    def __init__(self) -> None:
        self.results: list[dict] = []
        self.invalid_values: DataFrame | None = None

    def _keep(self, entry: dict) -> dict:
        self.results.append(entry)
        return entry

    def schema(self, df: DataFrame, expected: Mapping[str, str] = rules.EXPECTED_TYPES) -> dict:
        rows = quality.schema_check(df, expected).collect()
        text = {"missing": "missing column {column}", "extra": "extra column {column}", "type": "column {column}: expected {expected}, got {actual}"}
        issues = [text[r["kind"]].format(**r.asDict()) for r in rows]
        return self._keep(_entry("Schema", issues, {"columns": len(df.columns), "expected_columns": len(expected)}, not any(r["fails"] for r in rows)))

    def completeness(self, df: DataFrame) -> dict:
        absent = [f"required column {c} is missing" for c in rules.REQUIRED_COLUMNS if c not in df.columns]
        detail = _by_column(quality.completeness(df))
        issues = absent + [f"column {c}: {d['missing_pct']:.2f}% missing" for c, d in detail.items() if d["failed"]]
        score = quality.completeness_score(df).first()[0]
        return self._keep(_entry("Completeness", issues, {"completeness_score_pct": score, "column_detail": detail}))

    def uniqueness(self, df: DataFrame) -> dict:
        stats = copies.uniqueness(df).first().asDict()
        issues = [f"{stats['duplicate_rows']} full-row duplicates ({stats['duplicate_rows_pct']:.2f}%)"] if stats["duplicate_rows"] else []
        return self._keep(_entry("Uniqueness", issues, stats))

    def validity(self, df: DataFrame) -> dict:
        ranges = _by_column(quality.range_checks(df)) if set(rules.RANGE_RULES) & set(df.columns) else {}
        issues = [f"column {c}: {d[k]} values {k.replace('_', ' ')}" for c, d in ranges.items() for k in ("below_min", "above_max") if d[k]]
        invalid = self.invalid_values = quality.category_checks(df)
        counts = {r["column"]: r["n"] for r in invalid.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
        issues += [f"column {c}: {n} values outside the list" for c, n in sorted(counts.items())]
        return self._keep(_entry("Validity", issues, {"range_checks": ranges, "invalid_value_counts": counts}))

    def outliers_zscore(self, df: DataFrame) -> dict:
        return self._outliers("Outliers_ZScore", quality.zscore_outliers(df))

    def outliers_iqr(self, df: DataFrame) -> dict:
        return self._outliers("Outliers_IQR", quality.iqr_outliers(df))

    def _outliers(self, name: str, table: DataFrame) -> dict:
        detail = _by_column(table)
        issues = [f"column {c}: {d['outlier_count']} outliers ({d['outlier_pct']:.2f}%)" for c, d in detail.items() if d["outlier_count"]]
        return self._keep(_entry(name, issues, {"column_detail": detail}))

    def outliers_isolation_forest(self, df: DataFrame, contamination: float = 0.12, seed: int = 42) -> dict:
        stats = forest.isolation_forest(df, contamination=contamination, seed=seed).first().asDict()
        if stats["outlier_count"] is None:
            issues = ["not enough rows for an isolation forest (10 needed)"]
        else:
            issues = [f"{stats['outlier_count']} outliers ({stats['outlier_pct']:.2f}%)"] if stats["outlier_count"] else []
        return self._keep(_entry("Outliers_IsolationForest", issues, {**stats, "contamination": contamination}))

    def distribution(self, df: DataFrame) -> dict:
        detail = _by_column(quality.distribution(df))
        issues = [f"column {c}: mean {d['mean']:.2f} out of bounds" for c, d in detail.items() if not d["mean_in_bounds"]]
        issues += [f"column {c}: not normal (p={d['ks_pvalue']:.4f})" for c, d in detail.items() if d["rejects_normality"]]
        return self._keep(_entry("Distribution", issues, {"column_detail": detail}))

    def relationships(self, df: DataFrame) -> dict:
        pearson, spearman = quality.pearson_matrix(df), quality.spearman_matrix(df).persist()
        checks = [r.asDict() for r in quality.correlation_bounds(spearman).collect()]
        issues = [f"{c['col_a']} vs {c['col_b']}: r={c['r']} outside [{c['min_r']}, {c['max_r']}]" for c in checks if not c["within_bounds"]]
        stats = {"pearson": [r.asDict() for r in pearson.collect()], "spearman": [r.asDict() for r in spearman.collect()], "expected": checks}
        return self._keep(_entry("Relationships", issues, stats))

    def checks(self) -> list[Callable[[DataFrame], dict]]:
        return [self.schema, self.completeness, self.uniqueness, self.validity, self.outliers_zscore, self.outliers_iqr,
                self.outliers_isolation_forest, self.distribution, self.relationships]

    def run_all(self, df: DataFrame, prefix: str | None = None) -> dict:
        """Every check in fixed order on one kept copy of the table.

        Writes ``<prefix>.txt/.json`` and, as a table of any size, every invalid value: ``<prefix>_invalid_values``.
        """
        kept = df.persist()
        for check in self.checks():
            check(kept)
        if prefix:
            self.invalid_values.write.mode("overwrite").parquet(f"{prefix}_invalid_values")
            next(r for r in self.results if r["check_type"] == "Validity")["stats"]["invalid_values_path"] = f"{prefix}_invalid_values"
        kept.unpersist()
        return self.report(df.sparkSession, prefix)

    def report(self, spark, prefix: str | None = None) -> dict:
        rows = spark.createDataFrame([(r["check_type"], r["passed"]) for r in self.results], "check_type string, passed boolean")
        summary = {**quality.roll_up(rows).first().asDict(), "details": self.results}
        if prefix:
            from lotmill.sources.tables import write_text

            write_text(json.dumps(summary, indent=2, default=str), f"{prefix}.json", spark)
            write_text(self.text(summary), f"{prefix}.txt", spark)
        return summary

    @staticmethod
    def text(summary: Mapping) -> str:
        lines = ["DATA VALIDATION", f"checks {summary['total']}  passed {summary['passed']}  failed {summary['failed']}  rate {summary['success_rate']:.1f}%"]
        for entry in summary["details"]:
            lines += ["", f"[{'PASS' if entry['passed'] else 'FAIL'}] {entry['check_type']}"]
            if "completeness_score_pct" in entry["stats"]:
                lines.append(f"  overall completeness {entry['stats']['completeness_score_pct']}%")
            if entry["check_type"] in ("Completeness", "Distribution"):
                for column, detail in entry["stats"].get("column_detail", {}).items():
                    lines.append("  " + column + ": " + "  ".join(f"{k}={v}" for k, v in detail.items()))
            lines += [f"  - {issue}" for issue in entry["issues"]]
        return "\n".join(lines) + "\n"
