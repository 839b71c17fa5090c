"""Phrase collocations against a plain count of all phrases."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ledgerwing.llm import collocations as co

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, phrase string, n long, gram long"


def plain(rows, least, top):
    """Every contiguous phrase of every piece, counted one by one."""
    counts, total = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        f = counts.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = [w for w in re.split(r"[ \t]+", piece) if w]
            total[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    f[tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        kept = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in kept.items():
            inside = any(
                b >= a and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in kept.items()
            )
            if inside:
                continue
            score, _, l, r = min(
                (1000 * a * total[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]])
                for k in range(1, len(p))
            )
            found.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


def mined(spark, rows, least, top=2000):
    data = [(i, text, lang, "x", 1, 2) for i, (text, lang) in enumerate(rows)]
    df = co.collocations(spark.createDataFrame(data, SCHEMA), least, top)
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in df.collect())


def text_of(rng, n, words):
    marks = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", " ; "]
    return "".join(rng.choice(words) + rng.choice(marks) for _ in range(n))


def test_small_vocabulary_matches_a_plain_count(spark):
    rng = random.Random(1)
    words = "A b the The of Öl öl ÉT 100% a-b x\x00y 日本".split()
    rows = [(text_of(rng, rng.randint(0, 90), words), rng.choice(["en", "de", None, "und"])) for _ in range(150)]
    line = "all rights are reserved by the owner of this long line"
    rows += [(line + ".", "en")] * 30 + [(None, "en"), ("", None), ("...", "fr"), (" \t ", "fr")]
    want = plain(rows, 8, 2000)
    assert {r[0] for r in want} == {"en", "de", "und"} and len(want) > 100
    assert mined(spark, rows, 8) == want


def test_only_the_first_are_returned_and_ties_go_by_the_phrase(spark):
    rows = [("b a\nb c\nd e\nz y", "en")] * 5
    want = plain(rows, 5, 2)
    assert [r[2] for r in want] == ["b a", "b c"] or [r[2] for r in want] == ["d e", "z y"]
    assert mined(spark, rows, 5, 2) == want


def test_repeated_words_and_whole_paths(spark):
    rows = [("ha ha ha ha ha ha ha", "en")] * 4 + [("one two three four five six seven", "en")] * 6
    assert mined(spark, rows, 4) == plain(rows, 4, 2000)


def test_no_rows_and_no_frequent_phrase(spark):
    assert mined(spark, [], 2) == []
    assert mined(spark, [("one two", "en")], 2) == []


def test_texts_longer_than_a_chunk(spark, monkeypatch):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(12)]
    spaced = " ".join(rng.choice(words) for _ in range(4000))
    rows = [(text_of(rng, 3000, words), "en"), (spaced, "en"), ("v" * 5000 + " w1 w2", "en")]
    monkeypatch.setattr(co, "CHUNK_BYTES", 700)
    batch = pa.RecordBatch.from_pydict({"lang": [r[1] for r in rows], "text": [r[0] for r in rows]})
    seen = Counter()
    bits = np.full(1 << co.BUCKET_BITS - 3, 255, np.uint8)

    for chunk, _ in co.chunks(iter([batch])):
        for grams in co.longest_grams(chunk, bits) if chunk.n_starts else ():
            for gram, n in zip(grams.text.to_pylist(), grams.times.tolist(), strict=True):
                for k in range(1, grams.words + 1):
                    seen[" ".join(gram.split(" ")[:k])] += n
    want = Counter()
    for text, _ in rows:
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", text):
            w = [x for x in re.split(r"[ \t]+", piece) if x]
            for k in range(1, 6):
                want.update(" ".join(w[i : i + k]) for i in range(len(w) - k + 1))
    assert seen == want


def test_buckets_tell_only_rare_words(spark):
    rows = [("common pair of words", "en")] * 20 + [(f"rare{i} word{i}", "en") for i in range(50)]
    df = spark.createDataFrame(rows, "text string, lang string").select("lang", "text")
    bits = co.frequent_buckets(df, 20).bits
    # Four words and three pairs, of which two could share a bucket.
    assert 6 <= int(np.unpackbits(bits).sum()) <= 7


@pytest.mark.parametrize("least", [300, 20])
def test_counts_beyond_one_byte(spark, least):
    rows = [("a b c", "en")] * 310 + [("a b", "en")] * 5
    assert mined(spark, rows, least) == plain(rows, least, 2000)


def test_a_pair_in_most_texts_is_split(spark):
    rng = random.Random(3)
    rows = [("hot pair " + text_of(rng, 6, ["a", "b", "c"]), "en") for _ in range(200)]
    rows += [("hot pair", None)] * 60 + [("cold pair of words", "en")] * 30
    df = spark.createDataFrame(rows, "text string, lang string").fillna("und").select("lang", "text")
    assert len(co.frequent_buckets(df, 10).split) > 0
    assert mined(spark, rows, 10) == plain(rows, 10, 2000)


def test_unary_paths_are_whole_passages(spark):
    line = "all rights are reserved by the owner of this long line"
    rows = [(f"{line}, other {i}", "en") for i in range(9)] + [("here is by the owner and that house now", "en")] * 4
    rows += [("la le li lo lu la le li lo lu la le li lo lu", "fr")] * 5 + [("one two three four five", None)] * 4
    df = spark.createDataFrame(rows, "text string, lang string")
    counts, _ = co.graph(df, 4)
    got = {(r.lang, r.phrase): (r.words, r.n) for r in co.unary_paths(counts).collect()}
    assert got[("en", line)] == (11, 9) and got[("und", "one two three four five")] == (5, 4)
    assert got[("en", "here is by the owner and that house now")] == (9, 4)
    assert {p for lang, p in got if lang == "fr"}
    edges = {(r.lang, r.phrase): r.n for r in counts.where("words = 5").collect()}
    seen = Counter()
    for (lang, phrase), (words, n) in got.items():
        w = phrase.split(" ")
        assert len(w) == words
        for i in range(words - 4):
            key = (lang, " ".join(w[i : i + 5]))
            seen[key] += 1
            assert edges[key] == n
    assert seen == Counter(dict.fromkeys(edges, 1)), "every edge is on one path"
    assert co.unary_paths(counts.limit(0)).count() == 0
