"""Feature stages, splits, resampling and feature scores (families M, L, W6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotmill.functions.numeric import tier_code
from lotmill.operators import encode, sampling, selection
from lotmill.operators.smote import nearest_neighbours, smote
from lotmill.workload.listings import KEYS, listings, table, with_listings
from lotmill.workload.registry import query

_KEYS = ", ".join(KEYS)


@query("m1_listing_features", with_listings(f"""SELECT {_KEYS}, kilometer, power, 2026 - "yearOfRegistration" AS "vehicleAge", kilometer / (2026 - "yearOfRegistration" + 1) AS "kmPerYear", kilometer / (power + 1) AS km_power_ratio, round(ln(1 + kilometer), 6) AS log_km FROM listings"""))
def m1(spark, sf):
    rows = listings(spark, sf, *KEYS, "yearOfRegistration", "kilometer", "power")
    return encode.ListingFeatures(currentYear=2026).transform(rows).withColumn("log_km", F.round("log_km", 6))


@query("m2_frequency_encoding", with_listings("""SELECT l_orderkey, l_partkey, brand, model, round(b.f, 8) AS brand_freq, round(m.f, 8) AS model_freq FROM listings JOIN (SELECT brand, count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM listings) AS f FROM listings GROUP BY 1) b USING (brand) JOIN (SELECT model, count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM listings) AS f FROM listings GROUP BY 1) m USING (model)"""))
def m2(spark, sf):
    rows = listings(spark, sf, "l_orderkey", "l_partkey", "brand", "model")
    out = encode.FrequencyEncoder(cols=["brand", "model"]).fit(rows).transform(rows)
    return out.withColumns({"brand_freq": F.round("brand_freq", 8), "model_freq": F.round("model_freq", 8)})


_LEVELS = ["large", "medium", "promo", "small", "standard"]


@query("m3_one_hot", with_listings("SELECT l_orderkey, l_partkey, " + ", ".join(f"""CAST(coalesce("vehicleType" = '{v}', false) AS INTEGER) AS "vehicleType_{v}" """ for v in _LEVELS) + ", CAST(gearbox = 'manuell' AS INTEGER) AS gearbox_manuell FROM listings"))
def m3(spark, sf):
    rows = listings(spark, sf, "l_orderkey", "l_partkey", "vehicleType", "gearbox")
    return encode.DummyEncoder(cols=["vehicleType", "gearbox"]).fit(rows).transform(rows)


# rows get a place in their class by a hash of their keys and, among equal keys, of their copy number
_SPLIT_ROWS = """numbered AS (SELECT label, l_orderkey, l_partkey, l_suppkey, l_linenumber, c, row_number() OVER (PARTITION BY label, l_orderkey, l_partkey, l_suppkey, l_linenumber, c ORDER BY c) - 1 AS copy
 FROM (SELECT CASE price_tier WHEN 'budget' THEN 0 WHEN 'mid-range' THEN 1 ELSE 2 END AS label, l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(round(price * 100) AS BIGINT) AS c FROM listings)),
placed AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(concat_ws('|', 42, label, l_orderkey, l_partkey, l_suppkey, l_linenumber, c, copy))) AS rn, count(*) OVER (PARTITION BY label) AS nc, count(*) OVER () AS nt FROM numbered)"""


def labelled(spark, sf):
    return listings(spark, sf, *KEYS, "price", "price_tier").select(
        tier_code("price_tier").alias("label"), *KEYS, F.round(F.col("price") * 100).cast("long").alias("c"))


def _share(size: str, total: str, wanted: str) -> str:
    """Largest-remainder allocation per class as SQL over a table with one row per class."""
    return f"CAST(floor({wanted} * {size} / {total}) AS BIGINT) + CASE WHEN row_number() OVER (ORDER BY {wanted} * {size} / {total} - floor({wanted} * {size} / {total}) DESC, label) <= {wanted} - sum(CAST(floor({wanted} * {size} / {total}) AS BIGINT)) OVER () THEN 1 ELSE 0 END"


_ALLOC = f"""sizes AS (SELECT label, count(*) * 1.0e0 AS n, (SELECT count(*) FROM placed) * 1.0e0 AS t FROM placed GROUP BY 1),
test_sizes AS (SELECT *, {_share('n', 't', 'ceil(0.2e0 * t)')} AS k_test FROM sizes),
val_sizes AS (SELECT *, {_share('(n - k_test)', '(t - ceil(0.2e0 * t))', 'ceil(0.25e0 * (t - ceil(0.2e0 * t)))')} AS k_val FROM test_sizes)"""


@query("m4_stratified_split", with_listings(f"""SELECT p.label, {', '.join('p.' + k for k in KEYS)}, c, CASE WHEN rn <= k_test THEN 'test' WHEN rn <= k_test + k_val THEN 'val' ELSE 'train' END AS split FROM placed p JOIN val_sizes v ON p.label = v.label""", _SPLIT_ROWS, _ALLOC))
def m4(spark, sf):
    return sampling.stratified_split(labelled(spark, sf), "label")


@query("m5_undersample", with_listings(f"SELECT label, {_KEYS}, c FROM placed WHERE rn <= (SELECT min(nc) FROM placed)", _SPLIT_ROWS))
def m5(spark, sf):
    return sampling.undersample(labelled(spark, sf), "label")


@query("m6_sample_rows", with_listings(f"SELECT label, {_KEYS}, c FROM (SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', 42, label, l_orderkey, l_partkey, l_suppkey, l_linenumber, c, copy))) AS r FROM numbered) WHERE r <= 1500", _SPLIT_ROWS))
def m6(spark, sf):
    return sampling.sample_rows(labelled(spark, sf), 1500)


@query("w6_class_ranks", with_listings(f"SELECT label, {_KEYS}, c, rn AS class_rank FROM placed", _SPLIT_ROWS))
def w6(spark, sf):
    return sampling.class_ranks(labelled(spark, sf), "label")


@query("stratified_folds", with_listings("SELECT label, CAST((rn - 1) % 5 AS INTEGER) AS fold, count(*) AS n FROM placed GROUP BY 1, 2", _SPLIT_ROWS))
def folds(spark, sf):
    return sampling.stratified_folds(labelled(spark, sf), "label").groupBy("label", "fold").agg(F.count(F.lit(1)).alias("n"))


@query("m7_smote_class_sizes", """WITH g AS (SELECT CASE WHEN label < 2 THEN 0 WHEN label < 5 THEN 1 ELSE 2 END AS label FROM embeddings)
SELECT label, (SELECT max(n) FROM (SELECT count(*) AS n FROM g GROUP BY label)) AS n FROM g GROUP BY 1""")
def m7(spark, sf):
    rows = _vectors(spark, sf)
    names = [f"e{i}" for i in range(rows.select(F.max(F.size("x"))).first()[0])]
    rows = rows.select("label", *[F.col("x")[i].alias(c) for i, c in enumerate(names)])
    return smote(rows, names, "label").groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def _vectors(spark, sf):
    group = F.when(F.col("label") < 2, 0).when(F.col("label") < 5, 1).otherwise(2).alias("label")
    return table(spark, sf, "embeddings").select("vec_id", group, F.col("embedding").cast("array<double>").alias("x"))


@query("m7_class_neighbours", """WITH g AS (SELECT vec_id, CASE WHEN label < 2 THEN 0 WHEN label < 5 THEN 1 ELSE 2 END AS label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings)
SELECT label, vec_id, CAST(r AS INTEGER) AS rank, round(d, 6) AS d FROM (SELECT a.label, a.vec_id, list_distance(a.x, b.x) AS d, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.x, b.x)) AS r
 FROM g a JOIN g b ON a.label = b.label AND a.vec_id <> b.vec_id) WHERE r <= 5""")
def m7_neighbours(spark, sf):
    """The distances of every vector's five nearest of its class, over all components."""
    rows, out = _vectors(spark, sf), None
    for label in (0, 1, 2):
        near = nearest_neighbours(rows.where(F.col("label") == label).select(F.col("vec_id").alias("id"), "x", F.lit(1).alias("n")), vectors=False)
        one = near.select(F.lit(label).alias("label"), F.col("id").alias("vec_id"), F.posexplode("near").alias("pos", "e"))
        one = one.select("label", "vec_id", (F.col("pos") + 1).alias("rank"), F.round("e.d", 6).alias("d"))
        out = one if out is None else out.unionByName(one)
    return out


@query("m8_impute_and_scale", with_listings("""SELECT l_orderkey, l_partkey, round((price - avg(price) OVER ()) / stddev_pop(price) OVER (), 6) AS price, round((p - avg(p) OVER ()) / stddev_pop(p) OVER (), 6) AS power FROM (SELECT *, coalesce(nullif(power, 0), (SELECT median(nullif(power, 0)) FROM listings)) AS p FROM listings)"""))
def m8(spark, sf):
    rows = listings(spark, sf, "l_orderkey", "l_partkey", "price", "power").withColumn("power", F.nullif(F.col("power"), F.lit(0.0)))
    out = encode.impute_and_scale(rows, ["price", "power"])
    return out.withColumns({"price": F.round("price", 6), "power": F.round("power", 6)})


@query("m8_preprocessed", with_listings("""SELECT l_orderkey, l_partkey, round((p - avg(p) OVER ()) / stddev_pop(p) OVER (), 6) AS power, k AS "vehicleType", g AS gearbox, concat_ws(' ', dense_rank() OVER (ORDER BY k) - 1, (SELECT count(DISTINCT k) FROM filled) + dense_rank() OVER (ORDER BY g) - 1) AS levels FROM filled""",
"""gaps AS (SELECT l_orderkey, l_partkey, nullif(power, 0) AS power, CASE WHEN l_linenumber <> 2 THEN "vehicleType" END AS k, CASE WHEN l_linenumber <> 3 THEN gearbox END AS g FROM listings)""",
"""filled AS (SELECT l_orderkey, l_partkey, coalesce(power, (SELECT median(power) FROM gaps)) AS p, coalesce(k, (SELECT k FROM gaps WHERE k IS NOT NULL GROUP BY k ORDER BY count(*) DESC, k LIMIT 1)) AS k,
 coalesce(g, (SELECT g FROM gaps WHERE g IS NOT NULL GROUP BY g ORDER BY count(*) DESC, g LIMIT 1)) AS g FROM gaps)"""))
def m8_preprocessed(spark, sf):
    no = F.col("l_linenumber")
    rows = listings(spark, sf, "l_orderkey", "l_partkey", "l_linenumber", "power", "vehicleType", "gearbox").withColumns({
        "power": F.nullif(F.col("power"), F.lit(0.0)), "vehicleType": F.when(no != 2, F.col("vehicleType")), "gearbox": F.when(no != 3, F.col("gearbox"))})
    rows = rows.drop("l_linenumber")
    out = encode.Preprocessor(["power"], ["vehicleType", "gearbox"]).fit(rows).transform(rows)
    return out.withColumns({"power": F.round("power", 6), "levels": F.array_join(F.col("levels").cast("array<string>"), " ")})


@query("documented_features", with_listings(f"""SELECT {_KEYS}, CAST(gearbox = 'automatik' AS INTEGER) AS "isAutomatic", CAST(greatest(0, 2000 - "yearOfRegistration") >= 30 AS INTEGER) AS "isVintageClassic", round(ln(1 + power), 6) AS log_power, round(power / (greatest(0, 2000 - "yearOfRegistration") + 1), 6) AS power_per_age, CASE WHEN power < 100 THEN 'low' WHEN power < 200 THEN 'mid' ELSE 'high' END AS "powerTierBin" FROM listings"""))
def documented(spark, sf):
    from lotmill import rules
    from lotmill.functions.text import lookup_or_self

    rows = listings(spark, sf, *KEYS, "gearbox", "yearOfRegistration", "power").withColumn("gearbox", lookup_or_self("gearbox", rules.GEARBOX_ALIASES))
    out = encode.documented_features(rows, 2000).drop("gearbox", "yearOfRegistration", "power")
    return out.withColumns({"log_power": F.round("log_power", 6), "power_per_age": F.round("power_per_age", 6)})


# ---- feature scores --------------------------------------------------------------------------

_FEATURES = ["power", "kilometer", "yearOfRegistration", "l_linenumber"]
_CODE = "CASE price_tier WHEN 'budget' THEN 0 WHEN 'mid-range' THEN 1 ELSE 2 END"


def scored_rows(spark, sf):
    return listings(spark, sf, *_FEATURES, "price_tier").withColumn("label", tier_code("price_tier"))


@query("l2_variance_scores", with_listings(" UNION ALL ".join(f"""SELECT '{c}' AS feature, round(var_samp("{c}"), 4) AS score, var_pop("{c}") > 0.01 AS kept FROM listings""" for c in _FEATURES)))
def l2(spark, sf):
    out = selection.variance_scores(scored_rows(spark, sf), _FEATURES)
    return out.select("feature", F.round("score", 4).alias("score"), (F.col("population_variance") > 0.01).alias("kept"))


@query("l3_correlation_scores", with_listings(" UNION ALL ".join(f"""SELECT '{c}' AS feature, round(abs(corr("{c}", {_CODE})), 6) AS score FROM listings""" for c in _FEATURES)))
def l3(spark, sf):
    return selection.correlation_scores(scored_rows(spark, sf), _FEATURES, "label").withColumn("score", F.round("score", 6))


@query("l4_anova_scores", with_listings(" UNION ALL ".join(f"""SELECT '{c}' AS feature, round((sum(n * power(m - g, 2)) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*))), 4) AS score FROM (SELECT count(*) AS n, avg("{c}") AS m, var_pop("{c}") AS v, (SELECT avg("{c}") FROM listings) AS g FROM listings GROUP BY price_tier)""" for c in _FEATURES)))
def l4(spark, sf):
    return selection.anova_scores(scored_rows(spark, sf), _FEATURES, "label").withColumn("score", F.round("score", 4))


def _mi(c: str) -> str:
    cuts = "[" + ", ".join(f"quantile_cont(\"{c}\", {k / 10})" for k in range(1, 10)) + "]"
    return f"""SELECT '{c}' AS feature, round(greatest(sum(n * 1.0e0 / t * ln(n * 1.0e0 * t / (nb * ny))), 0), 6) AS score FROM (SELECT n, sum(n) OVER () AS t, sum(n) OVER (PARTITION BY b) AS nb, sum(n) OVER (PARTITION BY y) AS ny FROM (
 SELECT len(list_filter(list_distinct(k.cuts), lambda z: z <= "{c}")) AS b, price_tier AS y, count(*) AS n FROM listings, (SELECT {cuts} AS cuts FROM listings) k GROUP BY 1, 2))"""


@query("l5_mutual_information", with_listings(" UNION ALL ".join(_mi(c) for c in _FEATURES)))
def l5(spark, sf):
    return selection.mutual_information(scored_rows(spark, sf), _FEATURES, "label").withColumn("score", F.round("score", 6))


_LONG = " UNION ALL ".join(f"""SELECT '{c}' AS f, {_CODE} AS y, CAST(coalesce("{c}", 0) AS DOUBLE) AS v FROM listings""" for c in _FEATURES)


@query("l5_neighbour_information", with_listings("""SELECT f AS feature, round(greatest(h.d + s, 0), 6) AS score FROM (
 SELECT f, CAST(sum(n) AS BIGINT) AS t, sum(n * (a.d - b.d - c.d)) / sum(n) AS s FROM counted JOIN psi a ON a.i = used JOIN psi b ON b.i = size JOIN psi c ON c.i = m GROUP BY f) JOIN psi h ON h.i = t""", f"""long AS MATERIALIZED (SELECT f, y, v, count(*) AS n FROM ({_LONG}) GROUP BY ALL)""", """sized AS MATERIALIZED (SELECT * FROM (SELECT *, sum(n) OVER (PARTITION BY f, y) AS size, row_number() OVER (PARTITION BY f, y ORDER BY v) AS r FROM long) WHERE size > 1)""",
"""psi AS MATERIALIZED (SELECT i, sum(CASE WHEN i = 1 THEN -0.5772156649015329e0 ELSE 1.0e0 / (i - 1) END) OVER (ORDER BY i) AS d FROM (SELECT unnest(range(1, (SELECT count(*) + 1 FROM listings))) AS i))""",
"""reached AS (SELECT p.f, p.y, p.v, p.n, p.size, least(3, p.size - 1) AS k, abs(q.v - p.v) AS d, q.v AS w, sum(CASE WHEN q.v = p.v THEN q.n - 1 ELSE q.n END) OVER (PARTITION BY p.f, p.y, p.v ORDER BY abs(q.v - p.v), q.v) AS upto
 FROM sized p JOIN sized q ON p.f = q.f AND p.y = q.y AND q.r BETWEEN p.r - 3 AND p.r + 3)""",
"""kth AS MATERIALIZED (SELECT f, y, v, n, size, k, arg_min(d, upto) AS d, arg_min(w, upto) AS w FROM reached WHERE upto >= k GROUP BY ALL)""",
"""held AS MATERIALIZED (SELECT f, v, sum(n) AS n FROM sized GROUP BY f, v)""",
"""counted AS (SELECT p.f, p.y, p.v, p.n, p.size, CAST(CASE WHEN d = 0 THEN p.n ELSE k END AS BIGINT) AS used, CAST(sum(h.n) AS BIGINT) AS m FROM kth p JOIN held h ON p.f = h.f
 AND ((d = 0 AND h.v = p.v) OR (d > 0 AND h.v > (CASE WHEN w < p.v THEN w ELSE p.v - d END) AND h.v < (CASE WHEN w > p.v THEN w ELSE p.v + d END))) GROUP BY ALL)"""))
def l5_neighbours(spark, sf):
    out = selection.neighbour_scores(scored_rows(spark, sf), _FEATURES, "label")
    return out.withColumn("score", F.round("score", 6))


@query("l6_selected_columns", with_listings(f"""SELECT power, "yearOfRegistration", kilometer, l_linenumber, {_CODE} AS label FROM listings"""))
def l6(spark, sf):
    rows = scored_rows(spark, sf)
    selector = selection.FeatureSelector("variance").fit(rows, _FEATURES, "label")
    return selector.transform(rows, keep=["label"])
