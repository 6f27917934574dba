import itertools
import json
import unicodedata
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenframe.llm import digest, htmlextract, media, minhash, mixing, packing, pii, sharding, toxicity, urlfilter

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCS)


AWKWARD = [(1, None, None), (2, "", "a"), (3, "x " * 30000, "a"), (None, "one two", "b"), (4, "same text here", "b"), (4, "same text here", "b"), (5, "same text here", "b")]


def brute_components(texts):
    sets = {}
    for i, t in texts:
        w = (t or "").lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: find(i) for i in sets}


def test_mixing_reaches_targets_and_caps(spark):
    d = docs(spark, [(i, "w " * (i % 7), f"s{i % 3}") for i in range(900)])
    rows = mixing.mix(d).collect()
    total = sum(r["_size"] for r in rows)
    by = {r.source: (r["_target"], r["_source_size"]) for r in rows}
    assert abs(sum(t for t, _ in by.values()) - total) < 1e-6 and all(t <= 3 * s for t, s in by.values())
    taken = {s: sum(r["_copies"] * r["_size"] for r in rows if r.source == s) for s in by}
    assert all(abs(taken[s] - by[s][0]) < 0.15 * by[s][0] for s in by)
    assert mixing.emit(d).count() == sum(r["_copies"] for r in rows)


def test_mixing_level_equals_resharing(spark):
    sizes = {"a": 5, "b": 700, "c": 20, "d": 300, "e": 0}
    w = {"a": 1, "b": 2, "c": 3, "d": 1, "e": 2}
    target, free, left = {}, set(sizes), float(sum(sizes.values()))
    while True:
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        free -= over
    got = {r.source: r.target for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    assert got == pytest.approx(target)


def test_mixing_awkward(spark):
    assert mixing.mix(docs(spark, AWKWARD)).count() == len(AWKWARD)
    assert mixing.mix(docs(spark, AWKWARD).limit(0)).count() == 0


def test_mixing_draws_rows_without_id_separately(spark):
    d = docs(spark, [(None if i % 5 else i, f"w{i} v{i}", f"s{i % 3}") for i in range(1500)])
    target = {r.source: r["_target"] for r in mixing.mix(d).collect()}
    taken = {r.source: r.n for r in mixing.emit(d).groupBy("source").agg(F.sum(mixing.word_count(F.col("text"))).alias("n")).collect()}
    assert all(abs(taken[s] - target[s]) < 0.15 * target[s] for s in target)


def test_toxicity_learns_and_leaves_the_clean(spark):
    rng = np.random.default_rng(0)
    words = [f"wort{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(400):
        t = list(rng.choice(words, 40))
        bad, junk = i % 5 == 0, i % 7 == 0
        if bad:
            t[3] = t[20] = "vilename"
        rows.append((i, " ".join(x + "###" if junk else x for x in t), "a"))
        labels.append((i, int(not junk), int(bad)))
    d = docs(spark, rows)
    chain = toxicity.train(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    out = {r.doc_id: r["_p"][1] >= 0.5 for r in toxicity.score(d, chain).collect()}
    assert np.mean([out[i] == bool(t) for i, _, t in labels]) > 0.97
    assert chain.models[1].weights.shape[0] == 2 + 1 + len(chain.models[1].chosen)
    assert toxicity.score(docs(spark, AWKWARD), chain).count() == len(AWKWARD)
    none = toxicity.train(d, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert {r["_p"][1] for r in toxicity.score(d, none).collect()} == {0.0}


def test_cascade_is_exact(spark):
    keys = [f"k{i}.example.com" for i in range(3000)]
    listed = keys[::10]
    c = urlfilter.Cascade.build(spark.createDataFrame([(k,) for k in listed], "key string"), spark.createDataFrame([(k,) for k in keys], "key string"))
    got = {r.key for r in spark.createDataFrame([(k,) for k in keys], "key string").where(c.contains(F.col("key"))).collect()}
    assert got == set(listed) and len(c.levels) > 1


def test_url_rules(spark):
    urls = [(1, "http://a.net/x", "block"), (2, "https://EXAMPLE.net/en/1?q", "allow"), (3, "x.example.com", "allow"), (4, "http://x.example.com/de/1", "block"), (5, "http://m.adult-x.example.org/en", "block"), (6, None, "allow"), (7, "http://a.net", "allow"), (8, "http://adult-x.example.org/fr/1", "allow")]
    d = spark.createDataFrame([(i, u) for i, u, _ in urls], "page_id long, url string")
    assert {r.page_id: r["_verdict"] for r in urlfilter.filter_urls(d).collect()} == {i: v for i, _, v in urls}
    assert urlfilter.filter_urls(d.limit(0)).count() == 0
    assert urlfilter.filter_urls(d, listed=()).count() == len(urls)


@pytest.mark.parametrize("block", [1024, 5])
def test_minhash_equals_brute_force(spark, monkeypatch, block):
    # small blocks send each bucket and group through many cells
    monkeypatch.setattr(minhash, "BUCKET_ROWS", block)
    monkeypatch.setattr(minhash, "BLOCK_ROWS", block)
    rng = np.random.default_rng(3)
    base = [list(rng.choice([f"v{i}" for i in range(500)], 120)) for _ in range(6)]
    texts = []
    for i in range(90):
        t = list(base[i % 6])
        for _ in range(int(rng.integers(0, 9))):
            t[int(rng.integers(0, 120))] = "edit"
        texts.append((i, " ".join(t)))
    texts += [(100, texts[7][1]), (101, ""), (102, None), (103, "a b"), (104, "A b")]
    # repeated rows must not multiply
    again = [(3, texts[3][1])] * 40
    rows = minhash.link(docs(spark, [(i, t, "s") for i, t in texts + again])).collect()
    assert len(rows) == len(texts) + len(again)
    got = {r.doc_id: (r.component_id, r.kept) for r in rows}
    want = brute_components(texts)
    assert got == {i: (c, c == i) for i, c in want.items()}


def test_minhash_cells_hold_every_open_pair(spark):
    # key 1: a hot root and 7 others; key 2: one root only; key 3: all roots differ; key 4: fits one block
    rows = [(1, i, 0 if i < 200 else i) for i in range(207)] + [(2, 300 + i, 300) for i in range(50)] + [(3, 400 + i, 400 + i) for i in range(30)] + [(4, 500 + i, 500 + i // 2) for i in range(6)]
    size = {k: sum(r[0] == k for r in rows) for k in range(5)}
    d = spark.createDataFrame([(*r, 1, size[r[0]]) for r in rows], "h long, node long, root long, w long, all long")
    cells = {}
    for r in minhash._cells(minhash._parted(d, "h", 10)).collect():
        cells.setdefault((r.h, r.i, r.j), []).append(r)
    met = {(a.h, a.node, b.node) for c in cells.values() for a in c for b in c if a.i == a.j or a.block != b.block}
    assert all((h, a, b) in met for h, a, x in rows for g, b, y in rows if g == h and x != y)
    assert not any(h == 2 for h, _, _ in cells) and sum(len(c) for (h, _, _), c in cells.items() if h == 1) == 200 + 7 * 21
    assert {(i, j) for h, i, j in cells if h == 4} == {(0, 0)}


def test_minhash_awkward(spark):
    rows = minhash.link(docs(spark, AWKWARD).select("doc_id", "text")).collect()
    assert len(rows) == len(AWKWARD) and all(r.kept for r in rows if r.doc_id is None)
    assert {r.component_id for r in rows if r.doc_id in (4, 5)} == {4}
    assert minhash.link(docs(spark, AWKWARD).limit(0)).count() == 0


def test_images_round_trip():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 256, (37, 64), dtype=np.uint8)
    assert (media.decode(media.encode_pgm(a)) == a).all() and (media.decode(media.encode_bmp(a)) == a).all()
    assert media.decode(b"P2\n# c\n2 1\n9\n3 4\n").tolist() == [[3, 4]]
    assert media.decode(b"P1\n3 1\n1 0 1\n").tolist() == [[0, 1, 0]]
    assert media.decode(b"P4\n3 1\n\xa0").tolist() == [[0, 1, 0]]
    b = rng.random((12, 20))
    assert np.allclose(media.area_resize(b, 3, 5), b.reshape(3, 4, 5, 4).mean((1, 3)))
    assert np.isclose(media.area_resize(b, 7, 9, block=5).mean(), b.mean())


def test_media_payloads(spark):
    rows = media.media_columns(media.stored(docs(spark, AWKWARD))).collect()
    assert len(rows) == len(AWKWARD) and all(len(r["_pixels"]) % 64 == 0 and len(r["_pixels"]) > 0 for r in rows)
    assert {bytes(r["_pixels"]) for r in rows if r.n_bytes == 0} == {bytes(64)}


@pytest.mark.parametrize("score", ["norm", "dot"])
def test_best_fit_holds_every_capacity(score):
    rng = np.random.default_rng(1)
    h = {int(k): int(v) for k, v in zip(*np.unique(rng.integers(1, 1025, 5000), return_counts=True))}
    for cap in (packing.Capacity(score=score), packing.Capacity(documents=3, cost=700_000, score=score)):
        if cap.cost < 1024 * 1024:
            h = {k: v for k, v in h.items() if k * k <= cap.cost}
        kinds = packing.best_fit(h, cap)
        for kind, _ in kinds:
            assert sum(l * n for l, n in kind) <= cap.tokens and sum(n for _, n in kind) <= cap.documents and sum(l * l * n for l, n in kind) <= cap.cost
        assert sum(n * b for kind, b in kinds for _, n in kind) == sum(h.values())
    assert sum(b for _, b in packing.best_fit({512: 10, 256: 4})) == 6


def test_ids_equal_those_of_the_tokenizer():
    import random

    import public_tokenizers
    from lumenframe.llm.packing import Tokens

    t = Tokens(public_tokenizers.path("byte_bpe_50k.json"))
    assert t.plain is not None and Tokens(public_tokenizers.path("word_bpe_49k.json")).plain is None
    rng = random.Random(4)
    pieces = ["the", "aa", "Zr", "'s", "don't", "1234", "é", "日本", "\u0301", "🙂", "!!", "\n", "\t", "\u00a0", "\u3000", " ", " ", " ", " ", "<", "|", "<|endoftext|>", "\0", "x" * 40]
    texts = ["", " ", "a ", " a", "a\n b", "\n a b", " \u0085 x"] + ["".join(rng.choices(pieces, k=rng.randrange(1, 60))) for _ in range(3000)]
    texts += [f"a{chr(c)}a1{chr(c)}1 {chr(c)} !{chr(c)}!" for c in range(0x3500) if not 0xD800 <= c < 0xE000]
    texts += ["x" * 200_000, "a" + " " * 300_000 + "b", "日本語" * 20_000, "a\n" * 50_000]
    for text in texts:
        assert t.ids(text).tolist() == t.tokenizer.encode(text, add_special_tokens=False).ids, repr(text[:99])


def test_packing(spark):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    texts = [*AWKWARD, (9, "two  spaces\n\n and <|endoftext|> tabs\t x", "a"), (10, "Ünï cödé’s text " * 900, "a")]
    rows = packing.pack_documents(docs(spark, texts)).collect()
    t = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    for i, x, _ in texts:
        ids = np.array([*t.encode(x or "", add_special_tokens=False).ids, 2], "<u4")
        mine = {(r.start, r.length, r.ids_crc32) for r in rows if r.doc_id == i}
        assert {(s, n, zlib.crc32(ids[s : s + n].tobytes())) for s, n in packing.cuts(len(ids))} <= mine
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        places.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(places, places[1:])) and places[0][0] == 0 and sum(n for _, n in places) <= 1024
    assert packing.pack_documents(docs(spark, texts).limit(0)).count() == 0


def test_packing_takes_no_more_sequences_than_first_fit(spark):
    rng = np.random.default_rng(8)
    lengths = [int(x) for x in np.minimum(1024, rng.lognormal(5, 1.2, 3000).astype(int) + 1)] + [1] * 2000
    cut = spark.createDataFrame([(None if n == 1 else i, 0, 0, n, 7) for i, n in enumerate(lengths)], "doc_id long, piece int, start long, length long, ids_crc32 long")
    rows = packing.pack(cut, rows_a_group=300).collect()
    bins = []
    for n in sorted(lengths, reverse=True):
        k = next((k for k, free in enumerate(bins) if free >= n), None)
        if k is None:
            bins.append(1024)
            k = len(bins) - 1
        bins[k] -= n
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert len(by) <= len(bins) and len(rows) == len(lengths) and sorted(r.length for r in rows) == sorted(lengths)
    for places in map(sorted, by.values()):
        assert all(a + n == b for (a, n), (b, _) in zip(places, places[1:])) and places[0][0] == 0 and sum(places[-1]) <= 1024


def test_sharding(spark):
    d = docs(spark, [(i, "x" * (i % 50 * 7), "s") for i in range(2000)] + AWKWARD)
    rows = sharding.shard(d, shards=8, slots=256).collect()
    load = [sum(r["size"] for r in rows if r.shard == s) for s in range(8)]
    assert len(rows) == 2000 + len(AWKWARD) and max(load) - max(r["size"] for r in rows) < sum(load) / 8 * 1.1
    for s in range(8):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))


def test_slot_maps(spark, tmp_path):
    sizes = [int(x) for x in np.random.default_rng(0).integers(1, 100, 512)]
    m = sharding.SlotMap.balanced(sizes, 8)
    g = m.grown(sizes)
    assert all(g.owner[i] in (m.owner[i], 8) for i in range(512)) and g.version == 2 and g.loads(sizes)[8] > 0.9 * sum(sizes) / 9
    sizes[0] += 500
    r = g.rebalanced(sizes)
    assert max(r.loads(sizes)) <= max(g.loads(sizes))
    m.save(spark, str(tmp_path))
    assert sharding.SlotMap.load(spark, str(tmp_path), 1) == m


def page(i, extra=""):
    return f"<html><head><title>t</title><script>if (a<b) x('</p>')</script></head><body><header>Site</header><nav><a href=/>Home</a></nav><article><h1>Head {i}</h1><p>Words &amp; more {i}<br>of <b>it</b>\n  here.<p>Share this page<p>Last {i}</article><div class='comments'><p>I liked {i}</p></div>{extra}<footer>&copy; me</footer></body></html>"


def test_html(spark):
    rows = [(i, f"http://a.com/{i}", page(i)) for i in range(6)] + [(10, None, None), (11, "http://b.com", ""), (12, "http://c.com/", page(12, "<aside>x</aside>")[:-60]), (13, "http://d.com", "<body><div class=menu><a>x</a></div><div>Plain prose of a page without an article.</div>")]
    got = {r.page_id: r.text for r in htmlextract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[0] == "Head 0\nWords & more 0 of it here.\nLast 0"
    assert got[10] == got[11] == "" and got[13] == "Plain prose of a page without an article."
    assert got[12] == "Head 12\nWords & more 12 of it here.\nShare this page\nLast 12"


def extracted(spark, rows):
    return {r.page_id: r.text for r in htmlextract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_html_copies_are_no_evidence(spark):
    story = "".join(f"<p>Paragraph {k} of the long story that the site prints again.</p>" for k in range(6))
    copy = lambda i, more="": f"<body><nav>{i}</nav><div class=ad>Buy {i}</div><article><h1>Story</h1>{story}{more}</article></body>"
    lines = ["Story", *(f"Paragraph {k} of the long story that the site prints again." for k in range(6))]
    rows = [(i, f"http://a.com/{i}", copy(i)) for i in range(4)]
    # other articles, shorter, on a host of mostly copies, and versions that differ in a counter
    rows += [(100 + i, f"http://b.com/{i}", copy(i)) for i in range(40)] + [(200 + i, f"http://b.com/o{i}", f"<body><article><h1>Other {i}</h1><p>Short {i}</p><p>Share it</p></article></body>") for i in range(5)]
    rows += [(300 + i, f"http://c.com/{i}", copy(i, f"<p>Read {i}</p>")) for i in range(5)]
    got = extracted(spark, rows)
    assert all(got[i] == "\n".join(lines) for i in [*range(4), *range(100, 140)])
    assert got[201] == "Other 1\nShort 1" and got[303] == "\n".join([*lines, "Read 3"])


def test_html_layouts_and_bad_pages(spark):
    layouts = [
        lambda i: f"<body><div class=one><p>Text {i} of one</p><p>Notice of layout one</p></div></body>",
        lambda i: f"<body><section><div><p>Text {i} of two</p></div><p>Notice of layout two</p></section></body>",
        lambda i: f"<body><table><tr><td>Text {i} of three</td><td>Notice of layout three</td></tr></table></body>",
    ]
    rows = [(i, f"http://a.com/{i}", layouts[i % 3](i)) for i in range(18)]
    # whichever page has the least hash: more of them are null, empty or broken than good
    rows += [(100 + i, "http://a.com/x", [None, "", "<body><div class=one><p>Text of a broken page</p><p>Notice of layout one</p><p cla"][i % 3]) for i in range(30)]
    got = extracted(spark, rows)
    assert [got[i] for i in range(18)] == [f"Text {i} of {['one', 'two', 'three'][i % 3]}" for i in range(18)]
    assert got[100] == got[101] == "" and got[102] == "Text of a broken page"


def test_tree_matching_is_largest():
    a, b = htmlextract.parse("<div><p>1</p><ul><li>2</ul><p>3</p></div>"), htmlextract.parse("<div><ul><li>x<li>y</ul><p>3</p><p>4</p></div>")
    assert len(htmlextract.align(a, b)) == 5


def test_surrogates():
    p = pii.Permutation("k")
    for n in (2, 3, 10, 256, 1000):
        out = [p(x, n, "t") for x in range(n)]
        assert sorted(out) == list(range(n)) and all(x != y for x, y in enumerate(out))
    text = "Mail Ann.Lee@mail3.example.com or ann.lee@mail3.example.com, call +1 (988) 555-2485 or 988-555-2485, card 4111111111111111, ip 10.2.33.200, password=deadbeef00112233 and Frau Anna Schmidt."
    new, kinds = pii.pseudonymise(p, text)
    assert sorted(set(kinds)) == ["card", "email", "ip", "name", "phone", "secret"] and len(new) == len(text) + len(new.split("Frau ")[1]) - len(text.split("Frau ")[1])
    for x in ("988", "4111111111111111", "10.2.33.200", "deadbeef00112233", "Schmidt", "Anna"):
        assert x not in new
    first, second = [w.rstrip(",") for w in new.split() if "@" in w]
    assert first.lower() == second and first != second
    card = next(w.rstrip(",") for w in new.split() if w.rstrip(",").isdigit() and len(w) > 12)
    assert pii.luhn(card) == 0 and new.split("Frau ")[1].split()[0] in pii.NAMES["f", "latin"]
    clean = "Nothing to see on page 12 of 1999, or version 4.0 at 10:30."
    assert pii.pseudonymise(p, clean) == (clean, [])


@pytest.mark.parametrize("number", ["+14155550123", "4155550123", "+49 30 1234567", "+493012345678", "020 7946 0958", "030/1234567", "06 12 34 56 78", "0049 30 1234567", "+44 (0)20 7946 0958", "(030) 1234567", "0171-1234567"])
def test_telephone_forms(number):
    p = pii.Permutation("k")
    new, kinds = pii.pseudonymise(p, f"Call {number}, or not.")
    assert kinds == ["phone"] and new != f"Call {number}, or not."
    assert [c if not c.isdigit() else "0" for c in new] == [c if not c.isdigit() else "0" for c in f"Call {number}, or not."]


def test_spellings_names_and_ipv6():
    p = pii.Permutation("k")
    new = lambda t: pii.pseudonymise(p, t)[0]
    digits = lambda t: "".join(c for c in t if c.isdigit())
    assert digits(new("+442079460958")) == digits(new("+44 20 7946-0958")) and digits(new("+14155550123"))[1:] == digits(new("415-555-0123"))
    assert new("+44 (0)20 7946 0958").startswith("+44 (0)")
    for text, kept in (("then Anna went to see Peter, and Ольга too", "Anna Peter Ольга"), ("met Anna Schmidt there", "Anna Schmidt"), ("from 2001:db8:85a3::8a2e:370:7334 on", "85a3 8a2e"), ("2001:0DB8:0000:0000:0000:0000:0000:1A2F", "1A2F"), ("see fe80::1c2d now", "1c2d")):
        out, kinds = pii.pseudonymise(p, text)
        assert kinds and not any(w in out for w in kept.split()), out
    assert new("2001:db8::1a2f") in new("from 2001:db8::1a2f.") and "Paul " not in new("Paul and Paula")
    for clean in ("on 01.02.2024 10:30", "x[1::2] and std::find at 10:30:45", "02-03-2024", "1,000,000 of 1700000000", "Annabel Johnson and DeAnna"):
        assert pii.pseudonymise(p, clean) == (clean, [])


def test_surrogates_never_meet(spark):
    words = ["".join(w) for w in itertools.product("BKLPRTV", "aeiou", "klmnrx")] + ["Eva", "Max", "Karl", "Kurt"] + [a + b + c for a in "AEIOU" for b in "bcdfvnl" for c in "aeiou"]
    secrets = ["".join(w) for w in itertools.product("ab", "ac", "eg", "bh", ["cdef"])]
    numbers = ["+44 20 7946 0958", "+49 20 7946 0958", "020 7946 0958", "207-946-0958", "107-946-0958", "(107) 946-0958", "+442079460958", "+44 (0)20 7946 0958"]
    texts = [f"Frau {w} and Herr {w}" for w in words] + [f"token={x}" for x in secrets] + [f"call {n}." for n in numbers]
    d = docs(spark, [(i, t, "a") for i, t in enumerate(texts)])
    for key in map(str, range(3)):
        p = pii.Permutation(key)
        for kind, every in (("name|f", set(words)), ("secret", set(secrets)), ("phone", {n for n in numbers if n[1] != "4"})):
            assert len({pii.surrogate(p, kind, x) for x in every}) == len(every)
        assert len({pii.normal_form("phone", pii.surrogate(p, "phone", n)) for n in numbers}) == len({pii.normal_form("phone", n) for n in numbers})
    assert pii.checked_key(d, "0") == "0"


def test_redaction_rows(spark):
    d = docs(spark, AWKWARD + [(20, "call 555-123-4567 now", "a"), (21, "again 555-123-4567", "a")])
    key = pii.checked_key(d)
    rows = pii.redact(d, key).collect()
    assert len(rows) == len(AWKWARD) + 2 and next(r for r in rows if r.doc_id == 1).text is None
    assert len({w for r in rows if r.doc_id in (20, 21) for w in r.text.split() if "-" in w}) == 1


def test_canonical(spark):
    texts = ["É", "é", "ﬁne  STRASSE\t", "ậ", "ậ", "ệ", "Ａ①", "½ x", "Привет мир", "가나", "ΣΑΣ", " nbsp y ", "", "한́"]
    got = [r.c for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", digest.canonical(F.col("t")).alias("c")).orderBy("i").collect()]
    fold = lambda s: " ".join(unicodedata.normalize("NFKC", s).upper().lower().replace("ς", "σ").split())
    assert got == [fold(t) for t in texts]


def test_next_documents(spark):
    rows = [(i * 3 % 101, f"text {i}", "s") for i in range(101)]
    d = digest.with_next(docs(spark, rows).select("doc_id", "text"), ["doc_id"]).collect()
    assert len(d) == 101 and all(r["_next"].doc_id == (r.doc_id - 1) % 101 for r in d)
    assert digest.with_next(docs(spark, AWKWARD).select("doc_id", F.coalesce("text", F.lit("")).alias("text")), ["text"]).count() == len(AWKWARD)
    assert digest.with_next(docs(spark, rows).limit(0).select("doc_id", "text"), ["text"]).count() == 0
    groups = {r.doc_id: r.group for r in digest.exact_groups(docs(spark, [(1, "A b", "s"), (2, "a  B", "s"), (3, "c", "s")])).collect()}
    assert groups == {1: 1, 2: 1, 3: 3}


def test_pipeline_stages(spark, tmp_path):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(rng.choice([f"w{k}" for k in range(400)], 60)) + (" vilename vilename2" if i % 6 == 0 else ""), f"s{i % 2}") for i in range(120)]
    rows += [(500, rows[7][1], "s0"), (501, rows[7][1] + " more", "s0"), (502, "mail me a.b@mail1.example.com please", "s1")]
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 6 == 0)) for i in range(120)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    d = spark.read.parquet(f"{tmp_path}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    clean = stages["toxicity"](spark, d, str(tmp_path))
    kept = {r.doc_id for r in clean.collect()}
    assert clean.columns == d.columns and kept == {i for i, _, _ in rows if i >= 120 or i % 6}
    one = {r.doc_id for r in stages["near_duplicates"](spark, d, str(tmp_path)).collect()}
    assert one == {i for i, _, _ in rows} - {500, 501}
    assert stages["pii"](spark, d, str(tmp_path)).where("text like '%a.b@mail1%'").count() == 0
    assert corpus_pipeline.run(spark, str(tmp_path)).where("offset < 0").count() == 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "pii", "mixing", "packing"] and json.dumps(None) == "null"
