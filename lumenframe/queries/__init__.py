"""Registered queries over the fixture tables, with SQL for those that SQL can state."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.arrays import STATISTICS, normality, statistics
from ..functions.features import features, intensity_features, raw_features
from ..kernels import filters as K
from ..kernels.regions import SHAPE, TEXTURE, properties
from ..model import channels, frame, held, pixel_rows
from ..operators import filters, illumination, masking, normalization, projection, sampling, segmentation
from . import relational
from .rasters import IN_CIRCLE, NEAR, PX, PZ, SIDE, embedding_images, line_images

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
N = 3


def _register(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _stats_sql(v: str = "v", p: str = "") -> str:
    """The statistics of the non-null ``v`` in DuckDB, rounded."""
    m = f"avg({v})"
    parts = {
        "mean": m,
        "max": f"max({v})",
        "min": f"min({v})",
        "sum": f"sum({v})",
        "mad": f"mad({v})",
        "skewness": f"CASE WHEN var_pop({v}) > 0 THEN (avg({v} * {v} * {v}) - 3 * {m} * avg({v} * {v}) + 2 * {m} * {m} * {m}) / pow(stddev_pop({v}), 3) END",
        "kurtosis": f"CASE WHEN var_pop({v}) > 0 THEN kurtosis_pop({v}) END",
        "std": f"stddev_pop({v})",
        "median": f"quantile_cont({v}, 0.5)",
        "lower_quartile": f"quantile_cont({v}, 0.25)",
        "upper_quartile": f"quantile_cont({v}, 0.75)",
    }
    return ", ".join(f"round({x}, 6) AS {p}{s}" for s, x in parts.items())


def _masked(spark, sf_dir):
    return masking.apply(masking.make(line_images(spark, sf_dir), "circle"), N)


@_register(f"WITH {PX} SELECT event, CAST(channel AS INT) AS channel, {_stats_sql()} FROM px GROUP BY event, channel")
def raw_intensity(spark, sf_dir):
    d = held(line_images(spark, sf_dir).withColumn("_r", raw_features("pixels", "shape")), s=F.col("_r"))
    d = d.select("event", F.posexplode("s").alias("channel", "s"))
    return d.select("event", "channel", *_listed(F.col("s")))


def _listed(values, p: str = "") -> list:
    return [F.round(F.get(values, F.lit(i)), 6).alias(f"{p}{s}") for i, s in enumerate(STATISTICS)]


def _views(spark, sf_dir, wanted: dict[int, str], radius: int = 6):
    d = _masked(spark, sf_dir)
    d = held(d.withColumn("_u", intensity_features(radius)("pixels", "mask", "combined_mask", "background", "combined_background", "shape")), v=F.col("_u"))
    d = d.select("event", F.posexplode("v").alias("channel", "v"))
    return d.select("event", "channel", *(c for i, p in wanted.items() for c in _listed(F.get("v", F.lit(i)), f"{p}_")))


_BG = f"{PX}, bg AS (SELECT event, channel, avg(v) FILTER (NOT {IN_CIRCLE}) AS b FROM px GROUP BY 1, 2), w AS (SELECT px.*, b FROM px JOIN bg USING (event, channel))"


@_register(f"WITH {_BG} SELECT event, CAST(channel AS INT) AS channel, {_stats_sql('v', 'own_')}, {_stats_sql('(v - b)', 'bgcorr_')} FROM w WHERE {IN_CIRCLE} GROUP BY event, channel")
def masked_intensity_circle(spark, sf_dir):
    return _views(spark, sf_dir, {0: "own", 1: "bgcorr"})


@_register(f"WITH {_BG} SELECT event, CAST(channel AS INT) AS channel, {_stats_sql('v', 'combined_')}, {_stats_sql('(v - b)', 'combined_bgcorr_')} FROM w WHERE {IN_CIRCLE} GROUP BY event, channel")
def combined_mask_intensity(spark, sf_dir):
    return _views(spark, sf_dir, {4: "combined", 5: "combined_bgcorr"})


@_register(
    f"""WITH {_BG}, m AS (SELECT r, c FROM range({SIDE}) a(r), range({SIDE}) b(c) WHERE {IN_CIRCLE}),
    core AS (SELECT m.r, m.c FROM m JOIN m o ON (o.r - m.r) * (o.r - m.r) + (o.c - m.c) * (o.c - m.c) <= 4 GROUP BY 1, 2 HAVING count(*) = 13),
    e AS (SELECT * FROM m EXCEPT SELECT * FROM core)
    SELECT event, CAST(channel AS INT) AS channel, {_stats_sql('v', 'edge_')}, {_stats_sql('(v - b)', 'edge_bgcorr_')} FROM w JOIN e USING (r, c) GROUP BY event, channel"""
)
def edge_intensity(spark, sf_dir):
    """A disk of radius 2 leaves a core in these small frames; the default of 6 leaves none."""
    return _views(spark, sf_dir, {2: "edge", 3: "edge_bgcorr"}, radius=2)


def _projected(op):
    def query(spark, sf_dir):
        return pixel_rows(projection.project(line_images(spark, sf_dir, planes=True), op)).withColumn("v", F.round("v", 6))

    query.__name__ = f"zproject_{op}"
    f = {"max": "max(v)", "mean": "avg(v)", "median": "median(v)"}[op]
    return _register(f"WITH {PZ} SELECT event, CAST(channel AS INT) AS channel, CAST(r AS INT) AS r, CAST(c AS INT) AS c, round({f}, 6) AS v FROM pz GROUP BY ALL")(query)


for _op in ("max", "mean", "median"):
    _projected(_op)


@_register(f"WITH {PX} SELECT grp AS \"group\", CAST(channel AS INT) AS channel, min(v) AS lo, max(v) AS hi FROM px GROUP BY ALL")
def group_minmax(spark, sf_dir):
    return normalization.extremes(line_images(spark, sf_dir))


@_register(f"WITH {PX} SELECT grp AS \"group\", CAST(channel AS INT) AS channel, min(v) AS lo, max(v) AS hi FROM px WHERE {IN_CIRCLE} GROUP BY ALL")
def group_minmax_masked(spark, sf_dir):
    return normalization.extremes(_masked(spark, sf_dir))


def _normalized_sql(lo: str, hi: str) -> str:
    return f"""WITH {PX}, x AS (SELECT grp, channel, {lo} AS lo, {hi} AS hi FROM px GROUP BY ALL)
    SELECT event, CAST(channel AS INT) AS channel, CAST(r AS INT) AS r, CAST(c AS INT) AS c, round((v - lo) / nullif(hi - lo, 0), 6) AS v FROM px JOIN x USING (grp, channel)"""


@_register(_normalized_sql("min(v)", "max(v)"))
def minmax_normalize(spark, sf_dir):
    return pixel_rows(normalization.normalize(line_images(spark, sf_dir))[0]).withColumn("v", F.round("v", 6))


@_register(_normalized_sql("quantile_cont(v, 0.05)", "quantile_cont(v, 0.95)"))
def quantile_normalize(spark, sf_dir):
    return pixel_rows(normalization.normalize(line_images(spark, sf_dir), lower=0.05, upper=0.95)[0]).withColumn("v", F.round("v", 6))


@_register(f"WITH {PX} SELECT grp AS \"group\", " + ", ".join(f"{f}(v) FILTER (channel = {k}) AS {n}_{f}" for k, n in enumerate("ANR") for f in ("min", "max")) + " FROM px GROUP BY grp")
def channel_boundaries(spark, sf_dir):
    return normalization.channel_boundaries(normalization.extremes(line_images(spark, sf_dir)), list("ANR"))


_MEAN = f"{PX}, mu AS (SELECT grp, channel, r, c, avg(v) AS m FROM px GROUP BY ALL)"


@_register(f"WITH {_MEAN} SELECT grp AS \"group\", CAST((channel * {SIDE} + r) * {SIDE} + c AS INT) AS i, round(m, 6) AS m FROM mu")
def illum_mean_image(spark, sf_dir):
    return illumination.mean_images(line_images(spark, sf_dir), "group").select("group", F.posexplode("avg").alias("i", "m")).withColumn("m", F.round("m", 6))


@_register(f"WITH {_MEAN} SELECT event, CAST(channel AS INT) AS channel, CAST(r AS INT) AS r, CAST(c AS INT) AS c, round(v / nullif(m, 0), 6) AS v FROM px JOIN mu USING (grp, channel, r, c)")
def illum_correct(spark, sf_dir):
    d = line_images(spark, sf_dir)
    return pixel_rows(illumination.divide(d, illumination.mean_images(d, "group"), "group")).withColumn("v", F.round("v", 6))


@_register(
    f"""WITH {_MEAN}, o AS (SELECT a.grp, a.channel, a.r, a.c, median(b.m) AS s FROM mu a JOIN range(-1, 2) y(dy) ON true JOIN range(-1, 2) x(dx) ON true
      JOIN mu b ON b.grp = a.grp AND b.channel = a.channel AND b.r = greatest(0, least({SIDE - 1}, a.r + dy)) AND b.c = greatest(0, least({SIDE - 1}, a.c + dx)) GROUP BY ALL)
    SELECT event, CAST(channel AS INT) AS channel, CAST(r AS INT) AS r, CAST(c AS INT) AS c, round(v / CASE WHEN s = 0 THEN 1 ELSE s END, 5) AS v FROM px JOIN o USING (grp, channel, r, c)"""
)
def illum_correct_median(spark, sf_dir):
    return pixel_rows(illumination.correct(line_images(spark, sf_dir), "group", median_filter_size=3)).withColumn("v", F.round("v", 5))


@_register(
    f"""WITH {PX}, s AS (SELECT event, sum(v) AS filter_sum FROM px WHERE channel = 0 GROUP BY 1), f AS (SELECT avg(filter_sum) AS mu, stddev_pop(filter_sum) AS sd FROM s)
    SELECT event, filter_sum, filter_sum > mu - 1.6448536269514722 * sd AS kept FROM s, f"""
)
def threshold_filter(spark, sf_dir):
    return filters.threshold(line_images(spark, sf_dir)).select("event", "filter_sum", F.col("pixels").isNotNull().alias("kept"))


def _flags(spark, sf_dir, method, **settings):
    d = filters.mask_filters(line_images(spark, sf_dir), [{"method": method, "settings": settings}], 0, N)
    return d.select("event", F.col("pixels").isNotNull().alias("kept"), F.posexplode("mask_filter").alias("channel", "passes"))


def _flags_sql(test: str) -> str:
    return f"WITH {PX}, t AS (SELECT event, channel, {test} AS passes FROM px GROUP BY 1, 2) SELECT event, bool_or(passes AND channel = 0) OVER (PARTITION BY event) AS kept, CAST(channel AS INT) AS channel, passes FROM t"


@_register(_flags_sql("stddev_pop(v) > 26"))
def filter_std(spark, sf_dir):
    return _flags(spark, sf_dir, "std", threshold=26.0)


@_register(_flags_sql("max(v) - min(v) > 120"))
def filter_range(spark, sf_dir):
    return _flags(spark, sf_dir, "value_range", threshold=120.0)


#: CTEs from x (key, x) to b, which has what K-squared is made of.
_K2_CTE = """m AS (SELECT key, CAST(count(*) AS DOUBLE) AS n, avg(x) AS mu, var_pop(x) AS m2, kurtosis_pop(x) AS k,
    avg(x * x * x) - 3 * avg(x) * avg(x * x) + 2 * pow(avg(x), 3) AS m3 FROM x GROUP BY 1),
  a AS (SELECT *, m3 / pow(m2, 1.5) * sqrt((n + 1) * (n + 3) / (6 * (n - 2))) AS y,
    sqrt(2 * (3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)) - 1)) - 1 AS w2,
    (k + 3 - 3 * (n - 1) / (n + 1)) / sqrt(24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))) AS x,
    6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) AS sb FROM m),
  b AS (SELECT *, 6 + 8 / sb * (2 / sb + sqrt(1 + 4 / (sb * sb))) AS big FROM a),
  k2 AS (SELECT key, pow(asinh(y / sqrt(2 / (w2 - 1))) / sqrt(ln(w2) / 2), 2)
    + pow((1 - 2 / (9 * big) - cbrt((1 - 2 / big) / (1 + x * sqrt(2 / (big - 4))))) / sqrt(2 / (9 * big)), 2) AS k2 FROM b)"""


@_register(
    f"""WITH {PX}, x AS (SELECT (event, channel) AS key, v AS x, event, channel FROM px), {_K2_CTE},
    t AS (SELECT event, channel, coalesce(k2 > {filters.K2_LIMIT}, false) AS passes FROM (SELECT DISTINCT event, channel, (event, channel) AS key FROM px) LEFT JOIN k2 USING (key))
    SELECT event, bool_or(passes AND channel = 0) OVER (PARTITION BY event) AS kept, CAST(channel AS INT) AS channel, passes FROM t"""
)
def filter_normaltest(spark, sf_dir):
    return _flags(spark, sf_dir, "normaltest")


@_register(f"WITH x AS (SELECT vec_id AS key, unnest(embedding)::DOUBLE AS x FROM embeddings), {_K2_CTE} SELECT key AS event, round(k2, 6) AS k2 FROM k2")
def normality_statistic(spark, sf_dir):
    return embedding_images(spark, sf_dir).select("event", F.round(normality(F.col("pixels")), 6).alias("k2"))


@_register(f"WITH {PX}, t AS (SELECT event, r, c FROM px WHERE v > 100) SELECT event, coalesce(min(t.r), {SIDE})::INT AS minr, coalesce(min(t.c), {SIDE})::INT AS minc, coalesce(max(t.r) + 1, 0)::INT AS maxr, coalesce(max(t.c) + 1, 0)::INT AS maxc FROM ev LEFT JOIN t USING (event) GROUP BY event")
def bbox(spark, sf_dir):
    d = line_images(spark, sf_dir).withColumn("mask", F.transform("pixels", lambda v: v > 100)).withColumn("regions", F.lit(None))
    return masking.apply(d, N).select("event", "bbox.*")


@_register(
    f"""WITH {PX}, m AS (SELECT event, channel, r - min(r) OVER w AS r, c - min(c) OVER w AS c FROM px WHERE v > 20 WINDOW w AS (PARTITION BY event, channel)),
    x AS (SELECT *, r - avg(r) OVER w AS y, c - avg(c) OVER w AS x FROM m WINDOW w AS (PARTITION BY event, channel)),
    k AS (SELECT event, channel, count(*)::DOUBLE AS area, count(*) / ((max(r) + 1) * (max(c) + 1)) AS extent, sqrt(4 * count(*) / pi()) AS equivalent_diameter,
      {", ".join(f"sum(pow(r, {i}) * pow(c, {j}))::DOUBLE AS m{i}{j}" for i in range(4) for j in range(4))},
      {", ".join(f"sum(pow(y, {i}) * pow(x, {j})) AS c{i}{j}" for i in range(4) for j in range(4))} FROM x GROUP BY 1, 2),
    t AS (SELECT *, c02 / area AS t00, -c11 / area AS t01, c20 / area AS t11, c20 / (area * area) AS n20, c02 / (area * area) AS n02, c11 / (area * area) AS n11 FROM k),
    e AS (SELECT *, (t00 + t11) / 2 + sqrt(pow((t00 - t11) / 2, 2) + t01 * t01) AS l1, greatest((t00 + t11) / 2 - sqrt(pow((t00 - t11) / 2, 2) + t01 * t01), 0) AS l2 FROM t)
    SELECT event, CAST(channel AS INT) AS channel, area, round(extent + 1e-9, 6) AS extent, round(equivalent_diameter + 1e-9, 6) AS equivalent_diameter, round(4 * sqrt(l1) + 1e-8, 5) AS major, round(4 * sqrt(l2) + 1e-8, 5) AS minor,
      {", ".join(f"m{i}{j}" for i in range(4) for j in range(4))}, {", ".join(f"round(c{i}{j} + 1e-6, 3) + 0 AS c{i}{j}" for i in range(4) for j in range(4) if (i, j) not in ((0, 1), (1, 0)))},
      round(t00 + 1e-9, 6) + 0 AS t00, round(t01 + 1e-9, 6) + 0 AS t01, round(t11 + 1e-9, 6) + 0 AS t11, round(n20 + n02 + 1e-11, 8) AS hu0, round(pow(n20 - n02, 2) + 4 * n11 * n11 + 1e-11, 8) AS hu1 FROM e"""
)
def moments_inertia(spark, sf_dir):
    """Shape properties of the pixels over 20, each frame as one region, by the shipped kernel.

    Numbers are rounded a little above the half, where fractions of small areas would fall on it.
    """
    d = channels(line_images(spark, sf_dir)).where(F.array_max("v") > 20)

    @F.pandas_udf("array<double>")
    def of(v: pd.Series, h: pd.Series) -> pd.Series:
        return pd.Series([properties(np.asarray(x).reshape(rows, -1) > 20) for x, rows in zip(v, h)])

    at = {name: F.get("p", F.lit(i)) for i, name in enumerate(SHAPE)}
    r = lambda name, digits, alias=None: (F.round(at[name] + 10.0 ** -(digits + 3), digits) + 0).alias(alias or name)
    every = [(i, j) for i in range(4) for j in range(4)]
    out = [r("area", 0), r("extent", 6), r("equivalent_diameter", 6), r("major_axis_length", 5, "major"), r("minor_axis_length", 5, "minor")]
    out += [r(f"moments-{i}-{j}", 0, f"m{i}{j}") for i, j in every]
    # the first central moments are 0 but for rounding
    out += [r(f"moments_central-{i}-{j}", 3, f"c{i}{j}") for i, j in every if (i, j) not in ((0, 1), (1, 0))]
    out += [r("inertia_tensor-0-0", 6, "t00"), r("inertia_tensor-0-1", 6, "t01"), r("inertia_tensor-1-1", 6, "t11"), r("moments_hu-0", 8, "hu0"), r("moments_hu-1", 8, "hu1")]
    return held(d.select("event", "channel", "v", "h"), p=of("v", "h")).select("event", "channel", *out)


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _gradient(v: pd.Series, h: pd.Series) -> pd.Series:
    return pd.Series([K.sobel(np.asarray(x, float).reshape(rows, -1)).ravel() for x, rows in zip(v, h)])


@_register(
    f"""WITH {PX}, g AS (SELECT a.event, a.channel, a.r, a.c, sum(b.v * -dy * (2 - abs(dx))) AS gy, sum(b.v * -dx * (2 - abs(dy))) AS gx FROM px a {NEAR} GROUP BY ALL),
    s AS (SELECT event, channel, sqrt((gy * gy + gx * gx) / 32) AS s FROM g)
    SELECT event, CAST(channel AS INT) AS channel, round(avg(s), 6) AS sobel_mean, round(stddev_pop(s), 6) AS sobel_std, round(max(s), 6) AS sobel_max, round(min(s), 6) AS sobel_min FROM s GROUP BY 1, 2"""
)
def sobel_stats(spark, sf_dir):
    d = channels(line_images(spark, sf_dir)).select("event", "channel", _gradient("v", "h").alias("g"))
    d = held(d, s=statistics(F.col("g")))
    return d.select("event", "channel", *(F.round(F.col("s")[x], 6).alias(f"sobel_{x}") for x in ("mean", "std", "max", "min")))


for _name, _f in relational.QUERIES.items():
    QUERIES[_name] = _f
ORACLE_SQL |= relational.ORACLE_SQL


@_register()
def sample_k(spark, sf_dir):
    return sampling.sample(line_images(spark, sf_dir), 8).select("event", "group")


@_register()
def sample_k_replace(spark, sf_dir):
    return sampling.sample_with_replacement(line_images(spark, sf_dir), 200).select("_draw", "event", "group")


def _mask_query(method: str, sql: str | None = None, **settings):
    def query(spark, sf_dir):
        d = masking.make(line_images(spark, sf_dir), method, **settings)
        n = frame(F.col("shape"))
        each = F.transform("regions", lambda r, k: F.struct(k.alias("channel"), r.alias("regions"), F.size(F.filter(F.slice("mask", k * n + 1, n), lambda m: m)).alias("area")))
        # a lost event has no mask: its area is null
        return d.select("event", F.col("mask").isNull().alias("lost"), F.explode(each).alias("x")).select("event", "x.channel", "x.regions", F.when(~F.col("lost"), F.col("x.area")).alias("area"))

    query.__name__ = f"mask_{method}"
    _register(sql)(query)


#: Erosion, then dilation by a disk of radius 3; what they take away, over its 99 % quantile; regions off the edges.
_SPOT = f"""WITH RECURSIVE {PX}, o AS (SELECT dy, dx FROM range(-3, 4) a(dy), range(-3, 4) b(dx) WHERE dy * dy + dx * dx <= 9),
    er AS (SELECT a.event, a.channel, a.r, a.c, any_value(a.v) AS v, min(b.v) AS e FROM px a CROSS JOIN o JOIN px b ON b.event = a.event AND b.channel = a.channel AND b.r = a.r + dy AND b.c = a.c + dx GROUP BY a.event, a.channel, a.r, a.c),
    op AS (SELECT a.event, a.channel, a.r, a.c, any_value(a.v) - max(b.e) AS t FROM er a CROSS JOIN o JOIN er b ON b.event = a.event AND b.channel = a.channel AND b.r = a.r + dy AND b.c = a.c + dx GROUP BY a.event, a.channel, a.r, a.c),
    q AS (SELECT event, channel, quantile_cont(t, 0.99) AS q FROM op GROUP BY 1, 2),
    f AS (SELECT event, channel, r, c, r * {SIDE} + c AS id FROM op JOIN q USING (event, channel) WHERE t > q),
    reach AS (SELECT event, channel, id, id AS to_id FROM f UNION SELECT q.event, q.channel, q.id, b.id FROM reach q JOIN f a ON a.event = q.event AND a.channel = q.channel AND a.id = q.to_id
      JOIN f b ON b.event = a.event AND b.channel = a.channel AND abs(b.r - a.r) <= 1 AND abs(b.c - a.c) <= 1),
    l AS (SELECT event, channel, id, min(to_id) AS label FROM reach GROUP BY 1, 2, 3),
    s AS (SELECT l.event, l.channel, label, count(*) AS area, sum((r = 0)::INT + (r = {SIDE - 1})::INT + (c = 0)::INT + (c = {SIDE - 1})::INT) AS touching FROM l JOIN f USING (event, channel, id) GROUP BY 1, 2, 3),
    n AS (SELECT event, k.channel, count(label) AS regions, coalesce(sum(area), 0) AS area FROM ev CROSS JOIN range(3) k(channel) LEFT JOIN (SELECT * FROM s WHERE touching <= {SIDE // 4}) s USING (event, channel) GROUP BY 1, 2)
    SELECT event, CAST(channel AS INT) AS channel, CAST(regions AS INT) AS regions, CAST(CASE WHEN min(regions) FILTER (channel = 0) OVER (PARTITION BY event) > 0 THEN area END AS INT) AS area FROM n"""

for _m, _q, _s in (("li", None, {"smooth": [0.75, 0.5, 1.0]}), ("otsu", None, {}), ("sobel", None, {}), ("spot", _SPOT, {"spotsize": 3}), ("watershed", None, {"noisy_channels": [1]})):
    _mask_query(_m, _q, **_s)


@_register()
def segment_watershed(spark, sf_dir):
    d = segmentation.segment(line_images(spark, sf_dir), "watershed_dapi", {"cell_diameter": 4, "dapi_channel_index": 0})
    return d.select("event", "id", "bbox.*", F.size("pixels").alias("n"))


@_register()
def shape_full(spark, sf_dir):
    return features(_masked(spark, sf_dir), list("ANR"), ["shape"])


@_register()
def texture_full(spark, sf_dir):
    return features(_masked(spark, sf_dir), list("ANR"), ["texture"])


@_register()
def pipeline_full(spark, sf_dir):
    """Planes, illumination, filters, masks, normalisation and all features, by the plan layer."""
    from ..plans.pipeline import build

    config = {
        "load": {"channels": [0, 1, 2], "channel_names": list("ANR")},
        "project": {"method": "max"},
        "illumination_correction": {"key": "group", "settings": {"median_filter_size": 3}},
        "mask": {"filters": [{"method": "std", "settings": {"threshold": 0.1}}], "methods": [{"method": "circle", "name": "circle"}, {"method": "li", "name": "li", "settings": {"smooth": 0.75}}]},
        "filter": {"method": "threshold"},
        "normalization": {"group_by": "group"},
        "feature_extraction": {"types": ["regions", "bbox", "shape", "intensity", "texture"]},
    }
    return build(config, line_images(spark, sf_dir, planes=True), meta=["event", "group"]).features


__all__ = ["ORACLE_SQL", "QUERIES", "SHAPE", "TEXTURE"]
