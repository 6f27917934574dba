import json
import struct
import zlib

import numpy as np
import pytest
import yaml

from lumenframe import __main__ as cli
from lumenframe.sinks import tables
from lumenframe.sources import czi, tiff, zarr
from lumenframe.streaming import features as streaming


def write_tiff(frames, order="<", stored=1, predictor=1, tile=None):
    """A TIFF file of equally typed frames, in one strip each or in square tiles."""
    out = bytearray((b"II" if order == "<" else b"MM") + struct.pack(order + "HI", 42, 0))
    link = 4
    for x in frames:
        h, w = x.shape
        x = x.astype(x.dtype.newbyteorder(order))
        if tile:
            padded = np.zeros((-(-h // tile) * tile, -(-w // tile) * tile), x.dtype)
            padded[:h, :w] = x
            blocks = [padded[r : r + tile, c : c + tile] for r in range(0, h, tile) for c in range(0, w, tile)]
        else:
            blocks = [x]
        places = []
        for b in blocks:
            if predictor == 2:
                b = np.concatenate([b[:, :1], np.diff(b, axis=1)], axis=1).astype(x.dtype)
            raw = np.ascontiguousarray(b).tobytes()
            raw = zlib.compress(raw) if stored == 8 else b"".join(bytes([0, v]) for v in raw) if stored == 32773 else raw
            places.append((len(out), len(raw)))
            out += raw + b"\0" * (len(raw) % 2)

        def longs(values):
            if len(values) == 1:
                return values[0]
            at = len(out)
            out.extend(struct.pack(f"{order}{len(values)}I", *values))
            return at

        n = len(places)
        offsets, lengths = longs([a for a, _ in places]), longs([b for _, b in places])
        kind = {"u": 1, "i": 2, "f": 3}[x.dtype.kind]
        tags = [(256, 1, w), (257, 1, h), (258, 1, x.dtype.itemsize * 8), (259, 1, stored), (277, 1, 1), (317, 1, predictor), (339, 1, kind)]
        tags += [(322, 1, tile), (323, 1, tile), (324, n, offsets), (325, n, lengths)] if tile else [(273, n, offsets), (278, 1, h), (279, n, lengths)]
        out[link : link + 4] = struct.pack(order + "I", len(out))
        out += struct.pack(order + "H", len(tags)) + b"".join(struct.pack(order + "HHII", t, 4, c, v) for t, c, v in sorted(tags))
        link = len(out)
        out += b"\0" * 4
    return bytes(out)


@pytest.mark.parametrize("order", "<>")
@pytest.mark.parametrize("stored,predictor,tile", [(1, 1, None), (8, 2, None), (32773, 1, None), (8, 1, 4)])
def test_tiff_round_trip(order, stored, predictor, tile):
    x = np.random.default_rng(1).integers(0, 60000, (3, 7, 9)).astype(np.uint16)
    data = write_tiff(x, order, stored, predictor, tile)
    assert (tiff.decode(data) == x).all()
    assert (tiff.decode(data, [2, 0]) == x[[2, 0]]).all()


def test_tiff_refuses_what_it_cannot_read():
    with pytest.raises(ValueError):
        tiff.decode(b"no image at all")
    with pytest.raises(ValueError, match="compression 5"):
        tiff.decode(write_tiff(np.zeros((1, 2, 2), np.uint8), stored=5))


@pytest.fixture(scope="module")
def channel_folder(tmp_path_factory):
    folder = tmp_path_factory.mktemp("tiffs")
    for event in range(3):
        for channel in (1, 2):
            if (event, channel) != (2, 2):
                x = np.full((1, 6, 8), 10 * event + channel, np.uint16)
                x[0, 3, 4] = 200
                (folder / f"p1_test{event}_{channel}.tiff").write_bytes(write_tiff(x))
    return str(folder)


REGEX = r"^.+/(?P<plate>p\d+)_test(?P<id>\d+)_(?P<channel>\d+)\.tiff$"


def test_a_file_a_channel(spark, channel_folder):
    rows = {r.event: r for r in tiff.channel_files(spark, [channel_folder], [2, 1], REGEX).collect()}
    assert set(rows) == {"0", "1"}
    assert rows["1"].shape == [2, 6, 8] and rows["1"].pixels[0] == 12 and rows["1"].pixels[48] == 11
    assert rows["0"].path.endswith("test0_2.tiff") and rows["0"].plate == "p1"


def test_a_frame_a_channel(spark, tmp_path):
    (tmp_path / "a").mkdir()
    x = np.arange(4 * 3 * 5, dtype=np.float32).reshape(4, 3, 5)
    (tmp_path / "a" / "one.tiff").write_bytes(write_tiff(x))
    (row,) = tiff.frame_files(spark, [str(tmp_path)], [3, 1]).collect()
    assert row.shape == [2, 3, 5] and row.pixels == x[[3, 1]].ravel().tolist() and row.group.endswith("/a")


def write_zarr(path, images, step, compress):
    path.mkdir()
    flat = [x.ravel() for x in images]
    for k in range(0, len(flat), step):
        data = struct.pack("<I", len(flat[k : k + step])) + b"".join(struct.pack("<I", x.nbytes) + x.tobytes() for x in flat[k : k + step])
        (path / str(k // step)).write_bytes(zlib.compress(data) if compress else data)
    (path / ".zarray").write_text(json.dumps({"shape": [len(flat)], "chunks": [step], "dtype": "|O", "filters": [{"id": "vlen-array", "dtype": "<u2"}], "compressor": {"id": "zlib", "level": 1} if compress else None}))
    (path / ".zattrs").write_text(json.dumps({"shape": [x.shape for x in images], "object_number": list(range(100, 100 + len(flat)))}))


@pytest.mark.parametrize("compress", [True, False])
def test_zarr(spark, tmp_path, compress):
    rng = np.random.default_rng(2)
    images = [rng.integers(0, 900, (3, 4 + k, 6)).astype(np.uint16) for k in range(5)]
    write_zarr(tmp_path / "run.zarr", images, 2, compress)
    got = zarr.read(spark, [str(tmp_path / "run.zarr")], [2, 0], r"^.+\/(?P<group>.+).zarr$").orderBy("zarr_idx").collect()
    assert [r.object_number for r in got] == list(range(100, 105)) and {r.group for r in got} == {"run"}
    for r, x in zip(got, images):
        assert r.shape == [2, *x.shape[1:]] and r.pixels == x[[2, 0]].ravel().tolist()


def test_zarr_without_a_chunk_keeps_its_rows(spark, tmp_path):
    write_zarr(tmp_path / "run.zarr", [np.ones((1, 2, 2), np.uint16)] * 3, 2, False)
    (tmp_path / "run.zarr" / "1").unlink()
    got = zarr.read(spark, [str(tmp_path / "run.zarr")]).orderBy("zarr_idx").collect()
    assert [r.pixels is None for r in got] == [False, False, True]


def test_czi_scenes(spark):
    d = spark.createDataFrame([("x.czi", ["A1", "A2", "B1"], 2), ("y.czi", [], 3)], "path string, scenes array<string>, tiles int")
    at = lambda *a: sorted((r.scene, r.tile) for r in czi.events(d, *a).collect())
    assert at() == [(s, t) for s in ("A1", "A2", "B1") for t in (0, 1)]
    assert at("A") == [("A1", 0), ("A1", 1), ("A2", 0), ("A2", 1)] and at(["B1"]) == [("B1", 0), ("B1", 1)]
    assert czi.events(d, None, r"(?P<row>[A-Z])").select("row").distinct().count() == 2
    with pytest.raises(ValueError):
        czi.events(d, 5)


@pytest.mark.parametrize("limit,replace,expected", [(None, False, 2), (1, False, 1), (5, True, 5)])
def test_run_from_files_to_features(spark, channel_folder, tmp_path, limit, replace, expected):
    config = {
        "load": {"format": "tiff", "channels": [1, 2], "channel_names": ["a", "b"], "kwargs": {"regex": REGEX}},
        "mask": {"methods": [{"method": "circle", "name": "circle"}]},
        "normalization": {"group_by": "plate"},
        "feature_extraction": {"types": ["bbox", "intensity"]},
        "export": {"format": "anndata", "filename": "out"},
    }
    assert cli.run(spark, str(tmp_path), config, [channel_folder], limit, replace) > 0
    got = spark.read.parquet(str(tmp_path / "out.annotated.parquet"))
    names = spark.read.parquet(str(tmp_path / "out.var.parquet"))
    rows = got.collect()
    assert len(rows) == expected and all(len(r.X) == names.count() for r in rows) and all(r.obs.meta_event for r in rows)
    assert spark.read.option("header", True).csv(str(tmp_path / "channel_boundaries_circle")).count() == 1


def test_command_line(spark, channel_folder, tmp_path):
    config = {"load": {"format": "tiff", "channels": [1], "channel_names": ["a"], "kwargs": {"regex": REGEX}}, "feature_extraction": {"types": ["raw"]}}
    (tmp_path / "c.yml").write_text(yaml.safe_dump(config))
    out, timing = str(tmp_path / "out"), tmp_path / "t.json"
    assert cli.main([out, str(tmp_path / "c.yml")]) == 0
    assert cli.main(["--headless", "--timing", str(timing), out, str(tmp_path / "c.yml"), channel_folder]) == 0
    assert spark.read.parquet(f"{out}/features.parquet").count() == 3
    assert json.loads(timing.read_text())["runtime"] > 0 and "took" in (tmp_path / "out" / "run.log").read_text()
    with pytest.raises(SystemExit):
        cli.main(["--mode", "external", "relative", "c.yml", "here"])


def test_label_masks_need_keys(spark, tmp_path):
    d = spark.createDataFrame([("g", [1, 2, 2], [0] * 4)], "group string, shape array<int>, label_mask array<int>")
    assert spark.read.parquet(tables.label_masks(d, str(tmp_path), ["group"])).count() == 1
    with pytest.raises(ValueError):
        tables.label_masks(d, str(tmp_path), [])


def test_a_stream_equals_the_batch(spark, tmp_path):
    rows = [(k, "g", [1, 9, 9], [float((k * 7 + i) % 50) for i in range(81)]) for k in range(6)]
    d = spark.createDataFrame(rows, "event long, group string, shape array<int>, pixels array<double>")
    source = str(tmp_path / "in")
    d.repartition(3).write.parquet(source)
    corrections = spark.createDataFrame([("g", [2.0] * 81)], "group string, avg array<double>")
    apply = lambda x: streaming.masked_features(x, ["a"], ["bbox", "intensity"], corrections=corrections)
    query = streaming.write(apply(streaming.arriving(spark, source, d.schema, 1)), str(tmp_path / "out"), str(tmp_path / "checkpoint"), once=True)
    assert query.awaitTermination(120)
    got, want = spark.read.parquet(str(tmp_path / "out")), apply(d)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 6
