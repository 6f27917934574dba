"""Queries whose pixels meet by joins and windows: textures, thresholds, labels, overlaps, paths."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ..functions.arrays import per_pixel, total
from ..functions.features import texture_features
from ..kernels.labels import border_regions as kernel_border
from ..kernels.labels import label, otsu
from ..kernels.regions import TEXTURE
from ..model import channels, frame, held
from ..operators.segmentation import children_of, subtract, to_events
from ..sources.paths import path_columns, pivot_channels
from .rasters import NEAR, PX, SIDE, line_images

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def _register(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = f, sql
        return f

    return add


#: Co-occurrence levels: the edges below a value, of 16 that part a frame's range evenly.
_LEVELS = f"""{PX}, x AS (SELECT event, channel, min(v) AS lo, max(v) AS hi FROM px GROUP BY 1, 2),
  lv AS (SELECT event, channel, r, c, CAST(len(list_filter(range(0, 16), lambda k: CASE WHEN k = 15 THEN hi ELSE k * ((hi - lo) / 15) + lo END < v)) AS INT) AS l FROM px JOIN x USING (event, channel) WHERE hi > lo)"""
_PROPERTIES = {
    "contrast": "sum(w * (i - j) * (i - j))",
    "dissimilarity": "sum(w * abs(i - j))",
    "homogeneity": "sum(w / (1 + (i - j) * (i - j)))",
    "energy": "sqrt(sum(w * w))",
    "correlation": "CASE WHEN any_value(si) < 1e-15 THEN 1 ELSE sum(w * (i - mu) * (j - mu)) / any_value(si * si) END",
    "ASM": "sum(w * w)",
}


def _texture_sql() -> str:
    """All numbers of a frame's texture: each property's mean and deviation over two angles, and the gradient."""
    offsets = "(VALUES (3, 1, 2, 2), (3, 2, 2, -2), (5, 1, 4, 4), (5, 2, 4, -4)) o(d, angle, dy, dx)"
    each = ", ".join(f"{f} AS {p}" for p, f in _PROPERTIES.items())
    columns = [f"round({f}({p}) FILTER (d = {d}), 5) AS {p}_{name}_{d}" for p in _PROPERTIES for d in (3, 5) for name, f in (("mean", "avg"), ("std", "stddev_pop"))]
    return f"""WITH {_LEVELS}, p AS (SELECT a.event, a.channel, o.d, o.angle, a.l AS i, b.l AS j FROM lv a CROSS JOIN {offsets}
      JOIN lv b ON a.event = b.event AND a.channel = b.channel AND b.r = a.r + o.dy AND b.c = a.c + o.dx),
    m AS (SELECT event, channel, d, angle, i, j, count(*) AS n FROM (SELECT * FROM p UNION ALL SELECT event, channel, d, angle, j AS i, i AS j FROM p) GROUP BY ALL),
    q AS (SELECT *, n / sum(n) OVER f AS w, sum(n * i) OVER f / sum(n) OVER f AS mu FROM m WINDOW f AS (PARTITION BY event, channel, d, angle)),
    z AS (SELECT *, sqrt(sum(w * (i - mu) * (i - mu)) OVER (PARTITION BY event, channel, d, angle)) AS si FROM q),
    e AS (SELECT event, channel, d, angle, {each} FROM z GROUP BY 1, 2, 3, 4),
    g AS (SELECT a.event, a.channel, a.r, a.c, sum(b.v * -dy * (2 - abs(dx))) AS gy, sum(b.v * -dx * (2 - abs(dy))) AS gx FROM px a {NEAR} GROUP BY ALL),
    s AS (SELECT event, channel, sqrt((gy * gy + gx * gx) / 32) AS s FROM g),
    h AS (SELECT event, channel, round(avg(s), 5) AS sobel_mean, round(stddev_pop(s), 5) AS sobel_std, round(max(s), 5) AS sobel_max, round(min(s), 5) AS sobel_min FROM s GROUP BY 1, 2)
    SELECT event, CAST(channel AS INT) AS channel, {", ".join(columns)}, any_value(sobel_mean) AS sobel_mean, any_value(sobel_std) AS sobel_std, any_value(sobel_max) AS sobel_max, any_value(sobel_min) AS sobel_min
    FROM e JOIN h USING (event, channel) GROUP BY event, channel"""


@_register(_texture_sql())
def glcm_texture(spark, sf_dir):
    """The textures of whole frames, all numbers of the shipped features."""
    d = line_images(spark, sf_dir)
    n = frame(F.col("shape"))
    d = d.withColumns({"mask": F.array_repeat(F.lit(True), F.size("pixels")), "combined_mask": F.array_repeat(F.lit(True), n)})
    d = held(d, t=texture_features("pixels", "mask", "combined_mask", "shape"))
    d = d.select("event", F.posexplode(F.slice("t", 1, 3)).alias("channel", "t"))
    d = d.join(channels(line_images(spark, sf_dir)).where(F.array_min("v") < F.array_max("v")).select("event", "channel"), ["event", "channel"], "left_semi")
    return d.select("event", "channel", *(F.round(F.get("t", F.lit(i)), 5).alias(p) for i, p in enumerate(TEXTURE)))


@_register(
    f"""WITH {PX}, h AS (SELECT event, channel, v, count(*) AS n FROM px GROUP BY ALL),
    k AS (SELECT *, sum(n) OVER a AS w0, sum(n * v) OVER a AS s0, sum(n) OVER e AS w, sum(n * v) OVER e AS s FROM h
      WINDOW a AS (PARTITION BY event, channel ORDER BY v), e AS (PARTITION BY event, channel)),
    f AS (SELECT event, channel, v, CAST(w0 AS DOUBLE) * (w - w0) * pow(s0 / w0 - (s - s0) / (w - w0), 2) AS b FROM k WHERE w > w0)
    SELECT event, CAST(channel AS INT) AS channel, v AS threshold FROM (SELECT *, row_number() OVER (PARTITION BY event, channel ORDER BY b DESC, v) AS k FROM f) WHERE k = 1"""
)
def otsu_threshold(spark, sf_dir):
    """Largest between-class variance over the integer values of each frame, by the shipped kernel."""

    @F.pandas_udf("double")
    def cut(v: pd.Series) -> pd.Series:
        return pd.Series([otsu(np.asarray(x).astype(int)) for x in v])

    d = channels(line_images(spark, sf_dir)).where(F.array_min("v") < F.array_max("v"))
    return d.select("event", "channel", cut("v").alias("threshold"))


_TILE = "(r // 4) * 4 + c // 4 + 1"


def _components_sql(mask: str) -> str:
    """CTEs on ``f`` (event, r, c), the set pixels: label (event, id, label), eight-connected."""
    return f"""f AS (SELECT event, r, c, r * {SIDE} + c AS id FROM {mask}),
    reach AS (SELECT event, id, id AS to_id FROM f UNION SELECT q.event, q.id, b.id FROM reach q JOIN f a ON a.event = q.event AND a.id = q.to_id
      JOIN f b ON b.event = a.event AND abs(b.r - a.r) <= 1 AND abs(b.c - a.c) <= 1),
    l AS (SELECT event, id, min(to_id) AS label FROM reach GROUP BY 1, 2)"""


@_register(
    f"""WITH RECURSIVE {PX}, m AS (SELECT event, r, c FROM px WHERE channel = 0 AND v > 40), {_components_sql('m')},
    s AS (SELECT l.event, label, count(*) AS area, sum((r = 0)::INT + (r = {SIDE - 1})::INT + (c = 0)::INT + (c = {SIDE - 1})::INT) AS touching FROM l JOIN f USING (event, id) GROUP BY 1, 2)
    SELECT event, CAST(count(label) AS INT) AS regions, CAST(coalesce(sum(area), 0) AS INT) AS area FROM ev LEFT JOIN (SELECT * FROM s WHERE touching <= {SIDE // 4}) USING (event) GROUP BY event"""
)
def border_regions(spark, sf_dir):
    """Regions left, and their pixels, without those on the frame's edges by over a quarter of its side."""

    @F.pandas_udf("struct<regions:int,area:int>")
    def left(v: pd.Series, h: pd.Series) -> pd.DataFrame:
        done = [kernel_border(np.asarray(x).reshape(rows, -1) > 40) for x, rows in zip(v, h)]
        return pd.DataFrame({"regions": [n for _, n in done], "area": [int(m.sum()) for m, _ in done]})

    return channels(line_images(spark, sf_dir)).where("channel = 0").select("event", left("v", "h").alias("x")).select("event", "x.*")


@_register(
    f"""WITH {PX}, l AS (SELECT event, r, c, {_TILE} AS parent, CASE WHEN v > 20 THEN ((r + 2) // 4) * 5 + (c + 2) // 4 + 1 ELSE 0 END AS child FROM px WHERE channel = 1),
    a AS (SELECT event, parent, count(*) AS area FROM l GROUP BY 1, 2),
    k AS (SELECT event, parent, child, count(*) AS shared FROM l JOIN a USING (event, parent) WHERE child > 0 GROUP BY event, parent, child, area HAVING count(*) > 0.1 * area)
    SELECT event, CAST(parent AS INT) AS parent, CAST(sum(shared) AS BIGINT) AS pixels FROM k GROUP BY event, parent"""
)
def overlap_assign(spark, sf_dir):
    """Pixels that each parent gets: of children that overlap more than a tenth of its area."""

    @F.pandas_udf("array<struct<parent:int,pixels:long>>")
    def assigned(v: pd.Series, h: pd.Series) -> pd.Series:
        out = []
        for x, rows in zip(v, h):
            x = np.asarray(x).reshape(rows, -1)
            r, c = np.indices(x.shape)
            got = children_of(r // 4 * 4 + c // 4 + 1, np.where(x > 20, (r + 2) // 4 * 5 + (c + 2) // 4 + 1, 0))
            out.append([{"parent": int(k), "pixels": int(n)} for k, n in zip(*np.unique(got[got > 0], return_counts=True))])
        return pd.Series(out)

    d = channels(line_images(spark, sf_dir)).where("channel = 1")
    return d.select("event", F.explode(assigned("v", "h")).alias("x")).select("event", "x.*")


@_register(f"WITH {PX} SELECT event, CAST(r AS INT) AS r, CAST(c AS INT) AS c, CAST(({_TILE}) - CASE WHEN v > 20 THEN {_TILE} ELSE 0 END AS INT) AS label FROM px WHERE channel = 1")
def mask_subtract(spark, sf_dir):
    d = channels(line_images(spark, sf_dir)).where("channel = 1")
    tiles = per_pixel(F.col("h"), F.col("w"), lambda i, r, c: (F.floor(r / 4) * 4 + F.floor(c / 4) + 1).cast("int"))
    d = held(d, left=tiles).withColumn("right", F.zip_with("left", "v", lambda t, v: F.when(v > 20, t).otherwise(F.lit(0))))
    d = d.select("event", "w", F.posexplode(subtract(F.col("left"), F.col("right"))).alias("i", "label"))
    return d.select("event", F.expr("i div w").cast("int").alias("r"), F.expr("i % w").cast("int").alias("c"), "label")


@_register(
    f"""WITH {PX}, l AS (SELECT event, r, c, v, {_TILE} AS id FROM px WHERE channel = 0 AND v > 20)
    SELECT event || '_' || id AS event, CAST(id AS INT) AS id, CAST(min(r) AS INT) AS minr, CAST(min(c) AS INT) AS minc, CAST(max(r) + 1 AS INT) AS maxr, CAST(max(c) + 1 AS INT) AS maxc, count(*) AS area, sum(v) AS total FROM l GROUP BY event, id"""
)
def object_explode(spark, sf_dir):
    """One row an object of the first channel, by the shipped operator: box in the frame, area and sum."""
    d = line_images(spark, sf_dir)
    tiles = per_pixel(F.element_at("shape", -2), F.element_at("shape", -1), lambda i, r, c: (F.floor(r / 4) * 4 + F.floor(c / 4) + 1).cast("int"))
    n = frame(F.col("shape"))
    first = F.zip_with(tiles, F.slice("pixels", F.lit(1), n), lambda t, v: F.when(v > 20, t).otherwise(F.lit(0)))
    d = held(d, label_mask=F.flatten(F.array_repeat(first, F.element_at("shape", 1))))
    d = to_events(d.drop("group"), [], 0)
    n = frame(F.col("shape"))
    own = F.zip_with(F.slice("pixels", F.lit(1), n), F.slice("mask", F.lit(1), n), lambda v, m: F.when(m, v).otherwise(F.lit(0.0)))
    area = F.size(F.filter(F.slice("mask", F.lit(1), n), lambda m: m)).cast("long")
    return d.select("event", "id", "bbox.*", area.alias("area"), total(own).alias("total"))


@_register(
    f"""WITH RECURSIVE {PX}, m AS (SELECT event, r, c FROM px WHERE channel = 0 AND v > 40), {_components_sql('m')}
    SELECT event, CAST(label AS INT) AS label, count(*) AS area FROM l GROUP BY 1, 2"""
)
def label_components(spark, sf_dir):
    """Sizes of eight-connected components; a label is its first place in the frame."""
    @F.pandas_udf("array<struct<label:int,area:long>>")
    def sizes(v: pd.Series, h: pd.Series) -> pd.Series:
        out = []
        for x, rows in zip(v, h):
            lab, n = label(np.asarray(x).reshape(rows, -1) > 40)
            flat = lab.ravel()
            out.append([{"label": int(np.argmax(flat == k)), "area": int((flat == k).sum())} for k in range(1, n + 1)])
        return pd.Series(out)

    d = channels(line_images(spark, sf_dir)).where("channel = 0")
    return d.select("event", F.explode(sizes("v", "h")).alias("x")).select("event", "x.label", "x.area")


@_register(
    """WITH p AS (SELECT url AS path, regexp_extract(url, '^https?://([^/]+)/([a-z]+)/([0-9])', 1) AS plate, regexp_extract(url, '^https?://([^/]+)/([a-z]+)/([0-9])', 2) AS channel,
      regexp_extract(url, '^https?://([^/]+)/([a-z]+)/([0-9])', 3) AS id FROM pages)
    SELECT id, min(plate) AS plate, min(path) FILTER (channel = 'en') AS en, min(path) FILTER (channel = 'fr') AS fr FROM p WHERE id <> '' GROUP BY id
    HAVING count(*) FILTER (channel = 'en') > 0 AND count(*) FILTER (channel = 'fr') > 0"""
)
def regex_meta_pivot(spark, sf_dir):
    """Named groups from paths, one column a channel, rows with a missing channel dropped."""
    p = path_columns(spark.read.parquet(f"{sf_dir}/pages.parquet").select(F.col("url").alias("path")), r"^https?://(?P<plate>[^/]+)/(?P<channel>[a-z]+)/(?P<id>[0-9])")
    return pivot_channels(p, ["en", "fr"])
