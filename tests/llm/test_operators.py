"""The dealt operators against brute force, round trips and held-out rows, on hard small tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerwing.llm import (
    bpe,
    decontaminate,
    hnsw,
    langid,
    licenses,
    pii,
    rlz,
    run_index,
    simhash,
    warc,
)
from ledgerwing.llm.components import components
from ledgerwing.llm.queries import tokenizer_path
from ledgerwing.llm.repeats import Kind, remove_repeats
from ledgerwing.session import scratch_dir

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars int, ids string, key int, row int"
WORDS = ["alpha", "beta", "gamma", "delta", "the", "of", "Über", "ñandú", "x1", "42", "end."]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 60)) for _ in range(n))


def corpus(seed=1):
    """Copies, near copies, shared passages, repeated rows, ties, NULLs, empty and long texts."""
    rng = random.Random(seed)
    passage = prose(rng, 70)
    texts = [prose(rng, rng.randint(1, 150)) for _ in range(12)]
    texts += [texts[0], texts[1].upper(), texts[2] + " tail", passage, prose(rng, 20) + " " + passage]
    texts += [passage + "\n" + prose(rng, 30), "", None, " \t\n", "a b", "a b", prose(rng, 3000)]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(3, texts[3]), (5, "other text of five"), (None, texts[4]), (None, None), (-7, passage)]
    return [(i, t, "en", None, 1, "x", 0, 0) for i, t in rows]


def table(spark, rows=None):
    return spark.createDataFrame(corpus() if rows is None else rows, DOCS).repartition(3)


def bag(df):
    return Counter(map(tuple, df.collect()))


# --- 1: archives -----------------------------------------------------------------
PAGES = "page_id long, url string, html string, digest string, key string, file string"


def test_archive_round_trip(spark):
    html = ["<p>a</p>", "<p>a</p>", "", None, "é\r\n\r\n" * 50, "<p>a</p>", "x" * 300_000]
    rows = [(i, f"http://h{i % 2}.example.com/p?q={i}", h, "d", "k", "f") for i, h in enumerate(html)]
    rows += [(0, None, "<p>a</p>", "", "", ""), (None, "http://b.com", "z", "", "", ""), (None, "u v\n", "<p>a</p>", "", "", "")]
    rows += [(9, "http://h.com/a", "w", "", "", "")] * 2
    got = bag(
        warc.archive_and_read_back(spark.createDataFrame(rows, PAGES)).select(
            "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
        )
    )
    first = defaultdict(lambda: None)
    for i, _, h, *_ in rows:
        if i is not None and (first[h or ""] is None or i < first[h or ""]):
            first[h or ""] = i
    want = Counter()
    for i, _, h, *_ in rows:
        data, low = (h or "").encode(), first[h or ""]
        again = low is not None and i != low
        want[i, len(data), warc.sha1_base32(data), "revisit" if again else "response", low if again else None] += 1
    assert got == want


def test_lookup_finds_all_captures_of_a_key(spark):
    keys = [f"com,h{i % 7})/{i % 40}" for i in range(400)] + ["com,hot)/"] * 200
    rows = [(k, "f", 10 * i, 5) for i, k in enumerate(keys)]
    captures = spark.createDataFrame(rows, warc.CAPTURES)
    index = warc.build_index(captures, scratch_dir(spark, "idx"), block_lines=16)
    asked = ["com,h3)/3", "com,hot)/", "com,nothing)/", "", "zzz"]
    got = warc.lookup(index, spark.createDataFrame([(k,) for k in asked], "key string"))
    assert bag(got) == Counter(r for r in rows if r[0] in asked)


def test_empty_pages(spark):
    assert warc.archive_and_read_back(spark.createDataFrame([], PAGES)).count() == 0


# --- 2: decontamination ----------------------------------------------------------
def test_leaks_with_replaced_words(spark):
    rng = random.Random(3)
    item = [f"w{rng.randint(0, 10**6)}" for _ in range(40)]
    swapped = list(item)
    for at in (4, 15, 22, 33):
        swapped[at] = "other"
    docs = [
        (1, prose(rng, 30) + " " + " ".join(item) + " " + prose(rng, 9)),
        (2, prose(rng, 5) + " " + " ".join(swapped).upper()),
        (3, prose(rng, 200)),
        (4, " ".join(item[:6])),
        (5, None),
        (6, ""),
        (1, " ".join(item)),
    ]
    docs = spark.createDataFrame([(i, t, "", "", 0, "", 0, 0) for i, t in docs], DOCS)
    bench = spark.createDataFrame([(7, " ".join(item)), (8, None), (9, ""), (None, "a b")], "item_id long, text string")
    found = decontaminate.overlaps(docs, bench).collect()
    assert sorted((r.doc_id, r.item_id, r.n_words, r.n_same) for r in found) == [(1, 7, 40, 40), (1, 7, 40, 40), (2, 7, 40, 36)]
    assert sorted(r.doc_id for r in decontaminate.remove_contaminated(docs, bench).collect()) == [3, 4, 5, 6]
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.remove_contaminated(docs, none).count() == 7


def test_leaks_of_all_lengths_and_places(spark):
    rng = random.Random(4)
    wanted, docs, bench = {}, [], []
    for item, n in enumerate([1, 2, 4, 5, 6, 8, 9, 10, 12, 13, 15, 17, 20] * 3):
        words = [f"i{item}w{k}" for k in range(n)]
        bench.append((None if item % 13 == 9 else item % 30, " ".join(words)))
        for differ in range(n // 5 + 2):
            swaps = [rng.sample(range(n), min(n, differ)) for _ in range(4)]
            swaps += [list(range(differ)), list(range(n - differ, n))] if differ <= n else []
            for at in swaps:
                own = [f"other{k}" if k in at else w for k, w in enumerate(words)]
                same = [k not in at for k in range(n)]
                sizes = range(min(13, n), n + 1)
                leak = any(sum(same[a : a + z]) >= 0.8 * z for z in sizes for a in range(n - z + 1))
                wanted[len(docs)] = leak
                docs.append((len(docs), prose(rng, 12) + " " + " ".join(own) + " " + prose(rng, 12)))
    docs = spark.createDataFrame([(i, t, "", "", 0, "", 0, 0) for i, t in docs], DOCS)
    bench = spark.createDataFrame(bench, "item_id long, text string")
    found = decontaminate.overlaps(docs, bench).collect()
    assert {r.doc_id for r in found} == {i for i, leak in wanted.items() if leak}
    assert any(r.item_id is None for r in found)
    assert all(r.n_same >= 0.8 * r.n_words and r.share == r.n_same / r.n_words for r in found)


@settings(deadline=None)
@given(st.lists(st.booleans(), min_size=1, max_size=30), st.integers(1, 14))
def test_stretch_is_the_longest(same, least):
    ranges = [(a, b) for a in range(len(same)) for b in range(a + least, len(same) + 1)]
    good = [(a, b) for a, b in ranges if sum(same[a:b]) >= 0.8 * (b - a)]
    got = decontaminate.stretch(np.array(same), least)
    assert (got is None) == (not good)
    if got:
        size = max(b - a for a, b in good)
        longest = [(a, b) for a, b in good if b - a == size and a <= got[0] and got[1] <= b]
        assert got in good and sum(same[slice(*got)]) in {sum(same[a:b]) for a, b in longest}


# --- 3 and 6: repeats ------------------------------------------------------------
def _removed_by_brute_force(rows, split, length):
    ordered = [(i if i is not None else 2**63, split(t)) for i, t in rows]
    low = {}
    for i, s in ordered:
        for j in range(len(s) - length + 1):
            key = tuple(s[j : j + length])
            low[key] = min(i, low.get(key, i))
    out = []
    for (i, s), (doc, _) in zip(ordered, rows, strict=True):
        gone = [False] * len(s)
        for j in range(len(s) - length + 1):
            if low[tuple(s[j : j + length])] < i:
                gone[j : j + length] = [True] * length
        spans = [m.span() for m in re.finditer("1+", "".join("01"[g] for g in gone))]
        out.append((doc, len(s), tuple(spans), [x for x, g in zip(s, gone, strict=True) if not g]))
    return out


@pytest.mark.parametrize("what", ["words", "bytes"])
@pytest.mark.parametrize("frequent", [512, 0])
def test_repeats_equal_brute_force(spark, what, frequent):
    rng = random.Random(5)
    line = " ".join(rng.choice("abcd") for _ in range(30))
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 60))) for _ in range(25)]
    texts += [rng.choice(texts) + " " + line + " " + rng.choice(texts) for _ in range(25)]
    texts += [None, "", line * 40, "a " * 300, "é" * 80]
    rows = [(rng.choice([None, *range(40)]), t) for t in texts]
    docs = spark.createDataFrame([(i, t, "", "", 0, "", 0, 0) for i, t in rows], DOCS).repartition(4)
    if what == "words":
        kind, mark, keep = Kind(rlz.read_words, "<u8", 8, 4), rlz.mark, rlz.keep_words
        def split(t): return (t or "").encode().split()
        def glue(s): return b" ".join(s)
    else:
        kind, mark, keep = Kind(run_index.read_bytes, "u1", 12, 7), run_index.mark, run_index.keep_bytes
        def split(t): return list((t or "").encode())
        def glue(s): return bytes(s)
    got = Counter(
        (r.doc_id, r.n_symbols, tuple((s.start, s.end) for s in r.spans), bytes(r.kept))
        for r in remove_repeats(docs, kind, mark, keep, 1500, 1000, frequent).collect()
    )
    want = _removed_by_brute_force(rows, split, kind.length)
    assert got == Counter((d, n, s, glue(k)) for d, n, s, k in want)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.text("ab", min_size=9, max_size=30)), max_size=8), st.integers(7, 9))
def test_marks_equal_brute_force(pieces, length):
    least = {}
    for doc, text in sorted(pieces):
        least.setdefault(text, doc)
    ordered = sorted((d, t) for t, d in least.items())
    docs = np.array([d for d, _ in ordered], np.int64)
    first = np.concatenate(([0], np.cumsum([len(t) for _, t in ordered]))).astype(np.int64)
    want = [
        any(d2 < d and t[i : i + length] in t2 for d2, t2 in ordered)
        for d, t in ordered
        for i in range(len(t) - length + 1)
    ]
    text = "".join(t for _, t in ordered).encode()
    for module, dtype in ((run_index, np.uint8), (rlz, np.uint64)):
        symbols = np.frombuffer(text, np.uint8).astype(dtype)
        assert module.mark(symbols, first, docs, length).tolist() == want


def test_run_ends_locate_every_row():
    text = np.frombuffer(b"abracadabraabracadabra", np.uint8)
    first, docs = np.array([0, 11, 22]), np.array([0, 1])
    index = run_index.build(text, first, docs, 8)
    symbols = np.array([*(2 + text[:11].astype(int)), 1, *(2 + text[11:].astype(int)), 1])
    order, row_of, _ = run_index.suffix_order(symbols, 8)
    suffixes = [bytes(x - 1 for x in symbols[i:] % 256) for i in range(len(symbols))]
    assert [suffixes[i] for i in order] == sorted(suffixes)
    assert [index.locate(r) for r in range(len(order))] == order.tolist()
    assert index.end_rows.tolist() == row_of[[11, 23]].tolist()


@pytest.mark.parametrize("remove", [rlz.remove_passages, run_index.remove_strings])
def test_repeats_of_an_empty_table(spark, remove):
    assert remove(spark.createDataFrame([], DOCS)).count() == 0


# --- 4: BPE ----------------------------------------------------------------------
PATH = tokenizer_path()
HARD = ["a" * 500, "é" * 90 + "é" * 40, "don't''s''S" * 30, "<|endoftext|>x<|startoftext|>" * 9, "1234567890" * 20,
        "\x1c\x1d a b　c", "İıſΣς" * 25, "漢字" * 100, "!?" * 130, "foo_bar-baz/" * 20, "àb " * 50]


def _library(text):
    return bpe.encoder(PATH).whole(text)[0]


@pytest.mark.parametrize("leaf,window", [(16, 1), (40, 4), (64, 32)])
def test_tree_encodes_like_the_library(spark, leaf, window):
    rows = corpus() + [(100 + i, t, "", "", 0, "", 0, 0) for i, t in enumerate(HARD)]
    coded = bpe.encode(table(spark, rows), PATH, leaf, window)
    want = Counter((r[0], _library(r[1] or "").tobytes()) for r in rows)
    assert Counter((r.doc_id, bytes(r.ids)) for r in coded.collect()) == want
    tokenizer = bpe.encoder(PATH).tokenizer
    both = bpe.encode(table(spark, rows), PATH, leaf, window, decoded=True)
    assert bag(both.select("doc_id", "decoded")) == bag(bpe.decode(coded, PATH).select("doc_id", "decoded"))
    for r in bpe.decode(coded, PATH).collect():
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert r.decoded == tokenizer.decode(ids, skip_special_tokens=False)


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("ab e'sT.!_é́\n1<|>Σ漢\x1c "), max_size=120), st.integers(2, 20), st.integers(1, 5))
def test_joins_agree_with_the_library(text, leaf, window):
    coder = bpe.encoder(PATH)
    ends = bpe.leaf_bounds(len(text), leaf)
    pieces = []
    for a, b in zip([0, *ends[:-1]], ends, strict=True):
        ids, starts = coder.leaf(text[a:b])
        pieces.append((a, b, ids, starts + a))
    assert bpe.join_tree(coder, text, pieces, window)[2].tolist() == _library(text).tolist()
    assert np.frombuffer(coder.batch([text])[0], "<u4").tolist() == _library(text).tolist()


# --- 5: SimHash ------------------------------------------------------------------
def _fingerprint(text, shingle=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints(spark):
    rows = corpus()
    got = simhash.fingerprints(table(spark, rows)).select("doc_id", simhash.hex_of("fp"))
    assert bag(got) == Counter((r[0], f"{_fingerprint(r[1]):016x}") for r in rows)


@pytest.mark.parametrize("radius,segments", [(2, 2), (3, 2), (1, 4), (4, 4)])
def test_groups_equal_brute_force(spark, radius, segments):
    rng = random.Random(radius)
    centres = [rng.getrandbits(64) for _ in range(6)]
    fps = [0, 2**64 - 1]
    for c in centres:
        for _ in range(12):
            f = c
            for bit in rng.sample(range(64), rng.randint(0, 4)):
                f ^= 1 << bit
            fps.append(f)
    rows = [(rng.choice([None, *range(200)]), f - 2**64 if f >> 63 else f) for f in fps]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(fps):
        for j, b in enumerate(fps[:i]):
            if bin(a ^ b).count("1") <= radius:
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        groups[root(i)].append(doc)
    low = {g: min((d for d in docs if d is not None), default=None) for g, docs in groups.items()}
    got = simhash.near_groups(spark.createDataFrame(rows, "doc_id long, fp long"), radius, segments)
    assert bag(got) == Counter((doc, fp, low[root(i)]) for i, (doc, fp) in enumerate(rows))


def test_near_copies_keep_one_of_each(spark):
    rng = random.Random(8)
    base = [[f"v{rng.randint(0, 500)}" for _ in range(900)] for _ in range(20)]
    rows = []
    for i, words in enumerate(base):
        near = list(words)
        near[rng.randrange(900)] = "changed"
        rows += [(i, " ".join(words)), (100 + i, " ".join(near)), (200 + i, " ".join(words).upper())]
    rows += [(300, None), (301, ""), (302, "  "), (400, "one two"), (400, "one two"), (None, "only this"), (None, base[0][0])]
    rows += [(7, "another text of seven"), (500, "z" * (5 << 20) + " end of it")]
    schema = DOCS + ", row_ int, fp string, root int, _row int, tie string"
    data = [(i, t, "", "", 0, "", 0, k, k, "f", 1, k, "t") for k, (i, t) in enumerate(rows)]
    docs = spark.createDataFrame(data, schema).repartition(3)
    kept = simhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    got = kept.collect()
    # The same by brute force: links of at most two bits, components, smallest id.
    fps = [simhash.fingerprint((t or "").encode(), 3) for _, t in rows]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 2 and group[a] != group[b]:
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    best = {}
    for k, g in enumerate(group):
        rank = (rows[k][0] is None, rows[k][0] or 0)
        best[g] = min(best.get(g, (rank, k)), (rank, k))
    assert Counter(r.doc_id for r in got) == Counter(rows[k][0] for _, k in best.values())
    assert all(r.row_ == r._row == r.row and rows[r.row][1] == r.text for r in got)
    assert len(got) < len(rows) - 20
    assert simhash.keep_one_of_each(docs.limit(0)).count() == 0


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(50)}}


# --- 7: licences -----------------------------------------------------------------
def test_licences_equal_exact_containment(spark):
    rng = random.Random(2)
    rows = []
    for i in range(60):
        text = prose(rng, rng.randint(0, 120)).split()
        for _, wording in rng.sample(licenses.TEMPLATES, rng.randint(0, 3)):
            words = wording.split()
            if rng.random() < 0.3 and len(words) > 20:
                words[rng.randrange(len(words))] = "swapped"
            at = rng.randint(0, len(text))
            text[at:at] = words
        rows.append((i, " ".join(text).upper() if i % 5 == 0 else " ".join(text), "", "", 0, "", 0, 0))
    rows += corpus()
    got = bag(licenses.scan(table(spark, rows)))
    known = licenses.load_templates(licenses.default_templates(spark))
    want = Counter()
    for doc, text, *_ in rows:
        s = licenses.shingles_of([(text or "").lower().encode()])
        for name, template, block in zip(*known, strict=True):
            for a, b, share in licenses.occurrences(s.hash, template, block):
                want[doc, name, a, min(b + licenses.SHINGLE, int(s.words[0])), share] += 1
    assert got == want and len(want) > 40


# --- 8: nearest neighbours -------------------------------------------------------
def test_recall_ties_and_unusable_vectors(spark):
    rng = np.random.default_rng(4)
    v = rng.normal(size=(1500, 24)).tolist()
    rows = [(i, x) for i, x in enumerate(v)] + [(2000 + i, v[50]) for i in range(30)]
    rows += [(3000, None), (3050, [0.0] * 24), (3100, [None] + [1.0] * 23), (3150, [float("nan")] * 24)]
    rows += [(3200, [float("inf")] + [1.0] * 23), (3250, [1.0]), (None, v[0]), (3300, [])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    base = hnsw.build_index(hnsw.usable(vectors), 5, shard_rows=400)
    assert base.agg({"n": "sum"}).first()[0] == 1500 and base.count() > 2
    got = defaultdict(list)
    for r in hnsw.nearest(vectors, vectors.where("vec_id % 50 = 0")).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    good = [(i, np.array(x)) for i, x in rows if i is not None and x and len(x) == 24 and None not in x
            and np.isfinite(np.array(x, float)).all() and any(x)]
    ids, m = np.array([i for i, _ in good]), np.array([x for _, x in good])
    m = m / np.linalg.norm(m, axis=1, keepdims=True)
    hits = 0
    for q in ids[ids % 50 == 0]:
        score = m @ m[np.flatnonzero(ids == q)[0]]
        score[ids == q] = -9
        best = [int(ids[i]) for i in np.lexsort((ids, -np.round(score, 12)))[:5]]
        hits += len(set(best) & {i for i, _ in got[q]})
        for i, s in got[q]:
            assert abs(s - score[np.flatnonzero(ids == i)[0]]) < 1e-12
    assert [i for i, _ in got[50]] == [2000, 2001, 2002, 2003, 2004]
    assert hits / (5 * (ids % 50 == 0).sum()) >= 0.9
    assert set(got) == set(ids[ids % 50 == 0].tolist())
    assert hnsw.nearest(vectors.limit(0), vectors.limit(0)).count() == 0


# --- 9: languages ----------------------------------------------------------------
def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs)
    told = langid.predict(docs, model).collect()
    held = [r for r in told if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held) > 100
    assert all(0 <= r.score <= 1 for r in told)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 !?"), (4, "漢"), (None, "the and of")], "doc_id long, text string")
    got = {r.doc_id: (r.lang_pred, r.score > 0) for r in langid.predict(odd, model).collect()}
    assert [got[i] for i in (1, 2, 3)] == [("und", False)] * 3
    assert got[4][0] != "und" and got[None] == ("en", True)


def test_languages_without_or_with_one_label(spark):
    docs = spark.createDataFrame([(1, "abc", None), (3, "abc", None)], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in langid.predict(docs, langid.fit(docs)).collect()} == {"und"}
    one = docs.fillna("xx")
    assert {(r.lang_pred, r.score) for r in langid.predict(one, langid.fit(one)).collect()} == {("xx", 1.0)}


# --- 10: personal data -----------------------------------------------------------
IMPERSONAL = [
    "there are 12 345 678 people in it", "the ratio phi 1.6180339887 is golden", "they scored 1234567 points today",
    "items 100 200 300 400 are in stock", "from 1000000-2000000 units a year", "a population of 83200000 in 2020",
    "the distance of 384400000 m is large", "pi is 3.14159265358979 or so", "row 12  340  5600  78 of the table",
    "the years 1998 1999 2000 were dry", "see you @ home. Thanks for it", "points 10. 11. 12. 13 are open",
]


def test_thresholds_keep_their_precision_and_leave_ordinary_numbers_alone(spark):
    """Trees of the smaller corpus on rows of another one: both sorts, precision and recall."""
    trees = pii.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    assert all(t < 2 for t in trees.thresholds[1:])
    for text in IMPERSONAL:
        assert pii.select_spans(text, trees)[1] == [], text
    rows = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id % 5 = 0 AND text IS NOT NULL")
    found = Counter()
    for r in rows.select("text").collect():
        base = pii.base_spans(r.text)
        given = [(o, 1) for s in base for o in pii.rewritten(r.text, s)] + [(o, 0) for o in pii.impersonal(r.text, 1 if base else 0)]
        for (where, span), label in given:
            x = np.array([pii.features(where, span)], float)
            found[span.kind, label, bool(trees.score(x)[0] >= trees.thresholds[span.kind])] += 1
    taken = sum(n for (_, label, add), n in found.items() if add and label)
    wrong = sum(n for (_, label, add), n in found.items() if add and not label)
    missed = sum(n for (_, label, add), n in found.items() if not add and label)
    assert taken >= 0.99 * (taken + wrong)
    assert taken >= 0.5 * (taken + missed)


def test_a_kind_without_negatives_adds_nothing():
    x = np.array([pii.features("call +1 (504) 555-2652 now", pii.Span(pii.PHONE, 5, 22))] * 40, float)
    assert pii.fit_trees(x, np.ones(40)).thresholds == (2.0,) * 4


def _luhn(digits):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(digits[::-1])) % 10 == 0


def _plain_spans(text):
    def digits(m):
        return re.sub("[^0-9]", "", m.group())

    found = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            found.append((1, *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 16 <= len(digits(m)) <= 19 and _luhn(digits(m)):
            found.append((2, *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(digits(m)) <= 15:
            found.append((3, *m.span()))
    return found


PARTS = ["a.b@c.de", "x@y", "@", "_z%@q-r.s.t_u@v.w", "1.2.3.4", "256.1.1.1", "001.02.3.4.5.6.7.8", "+1 (504) 555-2652",
         "4111 1111 1111 1111", "4111111111111112", "+12", "+4-5(6)7.8 9 0 1 2", " ", "é", "9" * 40, "-", ".", "@b.c"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=9).map("".join))
def test_base_spans_equal_the_patterns(text):
    assert [tuple(s) for s in pii.base_spans(text)] == _plain_spans(text)


def test_spans_and_redaction(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    trees = pii.fit(docs)
    for r in pii.find_spans(docs, trees).join(docs.select("doc_id", "text"), "doc_id").collect():
        base = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in _plain_spans(r.text))
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(r.spans.split(","))
    text = "write to jane@doe.org or call +1 (504) 555-2652, ok"
    odd = spark.createDataFrame([(1, text, 7), (2, None, 7), (None, "", 7)], "doc_id long, text string, spans int")
    clean = {r.doc_id: r.text for r in pii.redact(odd, trees).collect()}
    assert clean == {1: "write to [EMAIL] or call [PHONE], ok", 2: None, None: ""}
    assert pii.find_spans(odd, trees).count() == 3
    assert pii.fit(odd.limit(0)).thresholds == (2.0,) * 4


def test_trees_learn_rewritten_numbers():
    rng = random.Random(6)
    texts = []
    for _ in range(300):
        number = f"({rng.randint(100, 999)}) {rng.randint(100, 999)}-{rng.randint(1000, 9999)}"
        texts.append(f"please call me at +1 {number} today, order {rng.randint(10**6, 10**9)}x or 20{rng.randint(10, 99)}")
    rows = [r for t in texts for r in pii.labelled(t)]
    trees = pii.fit_trees(np.array([x for x, _ in rows], float), np.array([y for _, y in rows]))
    base, every = pii.select_spans("please call me at (504) 555-2652 today, order 93847561x", trees)
    assert base == [] and [(s.kind, s.start, s.end) for s in every] == [(pii.PHONE, 18, 32)]


def test_trees_add_forms_that_are_frequent_in_the_corpus():
    """Natural forms in most texts must not count against themselves."""
    rng = random.Random(9)

    def luhn_digits(n):
        body = "".join(rng.choice("123456789") for _ in range(n - 1))
        return next(body + d for d in "0123456789" if _luhn(body + d))

    def wrong(digits):
        return digits[:-1] + str((int(digits[-1]) + 1) % 10)

    def part():
        return rng.randint(0, 255)

    rows = []
    for k in range(600):
        number = f"({rng.randint(200, 999)}) {rng.randint(200, 999)}-{rng.randint(1000, 9999)}"
        card = luhn_digits(16)
        strict = [f"+1 {number}", f"u{k}@site{k % 7}.org", " ".join(card[i : i + 4] for i in (0, 4, 8, 12))]
        strict.append(f"{part()}.{part()}.{part()}.{part()}")
        natural = [number, f"u{k} [at] site{k % 7}.org", luhn_digits(15), f"{part()} . {part()} . {part()} . {part()}"]
        none = [f"20{k % 30:02}-0{1 + k % 9}-1{k % 10}", wrong(luhn_digits(15)), f"{300 + k % 600}.{part()}.{part()}.{part()}"]
        none += [f"{rng.randint(10, 99)}.{rng.randint(10**6, 10**7)}"]
        rows += pii.labelled("; ".join(f"reach us via {x} today" for x in strict + natural + none))
    mix = rng.sample(range(len(rows)), len(rows))
    trees = pii.fit_trees(np.array([rows[i][0] for i in mix], float), np.array([rows[i][1] for i in mix]))
    wanted = {"(504) 555-2652": "phone", "jane [at] doe.org": "email", "371449635398431": "card", "10 . 0 . 17 . 4": "ip"}
    for form, kind in wanted.items():
        text = f"reach us via {form} today"
        assert kind in pii.spans_text(pii.select_spans(text, trees)[1]), form
    for form in ("2019-04-13", "371449635398432", "10.5552652", "700.0.17.4"):
        assert "card" not in (got := pii.spans_text(pii.select_spans(f"reach us via {form} today", trees)[1])), form
        assert "ip" not in got and ("phone" not in got or form == "371449635398432"), form


# --- columns of any name, and junk -------------------------------------------------
ODD_COLUMNS = ("key", "_key", "_bytes", "text_bytes", "_n", "row", "fp", "root", "leak", "leak_id", "H")


def test_columns_of_any_name_stay(spark):
    rng = random.Random(14)
    texts = [prose(rng, 60) for _ in range(30)]
    rows = [(i, t, "en", *[f"{c}{i}" for c in ODD_COLUMNS]) for i, t in enumerate(texts)]
    schema = "doc_id long, text string, lang string, " + ", ".join(f"{c} string" for c in ODD_COLUMNS)
    docs = spark.createDataFrame(rows, schema)
    item = spark.createDataFrame([(1, texts[3])], "item_id long, text string")
    model = langid.fit(docs)
    for got, gone in (
        (simhash.keep_one_of_each(docs), set()),
        (decontaminate.remove_contaminated(docs, item), {3}),
        (langid.predict(docs, model).drop("lang_pred", "score"), set()),
        (langid.told(docs, model, langid.calibrate(docs, model)).drop("lang_pred", "score"), set()),
        (pii.redact(docs, pii.fit(docs)), set()),
    ):
        assert got.columns == docs.columns
        assert sorted(map(tuple, got.collect())) == [r for r in rows if r[0] not in gone]


def test_more_labels_than_are_learned(spark):
    rows = [(i, f"text number {i} in words", f"l{i % 200:03}") for i in range(400)]
    rows += [(1000 + i, "the and of to in that is " * 3, "en") for i in range(40)]
    rows += [(2000 + i, "der die und das ist nicht ein " * 3, "de") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    assert len(model.langs) == langid.MAX_LANGS and {"en", "de"} <= set(model.langs)
    told = {r.doc_id: r.lang_pred for r in langid.predict(docs, model).collect()}
    assert all(told[1000 + i] == "en" and told[2000 + i] == "de" for i in range(40))


def test_junk_with_a_letter_is_rejected_and_clean_texts_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs)
    limits = langid.calibrate(docs, model)
    assert 0 < limits.score < 0.5 and 0 < limits.letters < 0.5
    kept = langid.told(docs, model, limits)
    assert kept.count() == langid.predict(docs, model).where("lang_pred <> 'und'").count()
    junk = [(1, "4711 0815 # 99 % x 12345 67890 11 12 13 14 15 16"), (2, "=" * 60 + "a"), (3, "§$%&/ 12 q !!! ??? 9999999999")]
    clean = [(4, "This."), (5, "the hand of the thing is there"), (6, "A."), (7, None), (8, "")]
    odd = spark.createDataFrame(junk + clean, "doc_id long, text string")
    assert {r.doc_id for r in langid.told(odd, model, limits).collect()} == {4, 5, 6}
    nothing = langid.calibrate(docs.limit(0), model)
    assert nothing == (0.0, 0.0)


def test_parallel_vectors_tie(spark):
    rng = random.Random(15)
    base = [rng.gauss(0, 1) for _ in range(64)]
    rows = [(i, [rng.gauss(0, 1) for _ in range(64)]) for i in range(100)]
    rows += [(100 + i, [x * (0.1 + 0.37 * i) for x in base]) for i in range(12)] + [(50, base)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = hnsw.nearest(vectors, vectors.where("vec_id = 50"), k=5).where("score > 0.9").orderBy("rank").collect()
    assert {(r.rank, r.vec_id) for r in got if r.vec_id >= 100} >= {(r, 99 + r) for r in (1, 2, 3, 4, 5)}


# --- models and limits of all rows ----------------------------------------------------
def test_trees_learn_from_every_document(spark):
    real = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("text IS NOT NULL").select("text").collect()
    ids = [r.id for r in spark.range(4000 + len(real)).orderBy(F.xxhash64("id")).collect()]
    texts = ["only plain words here"] * 4000 + [r.text for r in real]
    docs = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string")
    assert pii.training_patterns(docs).agg(F.sum("n")).first()[0] == sum(len(pii.labelled(r.text)) for r in real)
    assert all(t < 2 for t in pii.fit(docs).thresholds[1:])
    few = pii.fit(docs, max_patterns=50)
    assert len(few.value) == pii.TREES


def test_counted_rows_are_worth_their_number():
    texts = ["reach us at +1 (504) 555-2652 or 192.168.0.12, order 93847561 of 1234567 units"] * 3 + [
        f"call +49 30 {i}0123456 today, item no 12{i}45{i}78" for i in range(9)
    ]
    rows = [r for t in texts for r in pii.labelled(t)]
    x, y = np.array([x for x, _ in rows], float), np.array([y for _, y in rows])
    n, held = np.arange(len(y)) % 3 + 1, np.arange(len(y)) % 4 == 3
    whole = pii.fit_trees(x.repeat(n, axis=0), y.repeat(n), held=held.repeat(n))
    counted = pii.fit_trees(x, y, n, held)
    assert np.abs(whole.score(x) - counted.score(x)).max() < 0.05
    assert np.allclose(whole.thresholds, counted.thresholds, atol=0.05)


def test_limits_are_set_by_all_held_out_rows(spark):
    held = spark.range(12_000).where(langid.held_out(F.col("id"))).orderBy(F.xxhash64("id")).select("id").collect()
    assert len(held) > 2500
    rows = [(r.id, "a b 12345678" if i > len(held) - 50 else "plain words of a text", "en") for i, r in enumerate(held)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.Model(("en",), ())
    limits = langid.calibrate(docs, model)
    assert limits == langid.Limits(0.5, 0.1)
    assert langid.told(docs, model, limits).count() == len(rows)


def test_packed_shares_keep_values_and_order():
    rng = np.random.default_rng(3)
    rows = [np.zeros(1 << langid.BUCKET_BITS)]
    for _ in range(60):
        x = rows[rng.integers(len(rows))].copy()
        x[rng.integers(len(x), size=2)] = rng.integers(0, 4, size=2) / 7
        rows.append(x)
    dense = [x.astype("<f4") for x in rows]
    small = [langid.packed(x) for x in rows]
    assert (langid.unpacked(small) == np.stack(dense)).all()
    order = sorted(range(len(rows)), key=lambda i: (dense[i].tobytes(), i))
    assert order == sorted(range(len(rows)), key=lambda i: (small[i], i))
