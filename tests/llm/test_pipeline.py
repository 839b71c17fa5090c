"""The pipeline's stages, and every registered query on the smallest tables."""

import random
import re
import tracemalloc

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerwing.llm import decontaminate, langid, tokens
from ledgerwing.llm import queries as llm
from ledgerwing.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "embeddings", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(llm.ORACLES))
def test_matches_sql(spark, duck, name):
    got = llm.QUERIES[name](spark, SF)
    cur = duck.execute(llm.ORACLES[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(repr, map(tuple, got.select(columns).collect()))) == sorted(map(repr, cur.fetchall()))


def test_whole_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = corpus_pipeline.run(spark, SF).collect()
    assert 0.5 * docs.count() < len(out) < docs.count()
    assert len({r.doc_id for r in out}) == len(out)


def test_stages_keep_columns_and_clean_rows(spark):
    rng = random.Random(1)
    clean = [(i, " ".join(f"w{rng.randint(0, 5000)}" for _ in range(80)), "en", "s", 400, i) for i in range(40)]
    odd = [(100, None, "en", "s", 0, 0), (101, "", None, None, None, 0), (102, "!!! 123", "en", "s", 7, 0)]
    odd += [(103, clean[0][1], "en", "s", 400, 0), (104, clean[1][1] + " mail me@x.org", "de", "s", 1, 0), (0, *clean[0][1:])]
    docs = spark.createDataFrame(
        clean + odd, "doc_id long, text string, lang string, source string, n_chars int, extra int"
    )
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert stage(spark, docs.limit(0), SF).count() == 0, name
        docs = out
    rows = {r.doc_id: r for r in docs.collect()}
    assert set(rows) == set(range(40)) and docs.count() == 40
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 40


def test_personal_data_is_replaced(spark):
    docs = spark.createDataFrame([(1, "mail me@x.org now", "en", 17)], "doc_id long, text string, lang string, n_chars int")
    row = corpus_pipeline.redact_personal_data(spark, docs, SF).first()
    assert row.text == "mail [EMAIL] now" and row.n_chars == 16


# --- the whole pipeline by plain code -------------------------------------------------
def _fingerprint(text):
    """Three-word shingles, one vote per shingle and bit."""
    fold = text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = re.findall(r"[^\x20\x09-\x0D]+", fold)
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _plain_pipeline(rows, items):
    kept = [(i, t) for i, t in rows if t and any(c.isalpha() for c in t)]
    prints = [_fingerprint(t) for _, t in kept]
    group = list(range(len(kept)))
    for a in range(len(kept)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 2 and group[a] != group[b]:
                group = [group[b] if g == group[a] else g for g in group]
    first = {}
    for k, g in enumerate(group):
        first[g] = min(first.get(g, (1 << 60, 0)), (kept[k][0], k))
    kept = [kept[k] for _, k in sorted(first.values())]
    words = [re.findall(r"\w+", t.lower()) for t in items]
    runs = {" ".join(w[a : a + 13]) for w in words for a in range(len(w) - 12)}
    clean = []
    for i, t in kept:
        w = re.findall(r"\w+", t.lower())
        if not any(" ".join(w[a : a + 13]) in runs for a in range(len(w) - 12)):
            clean.append((i, re.sub(r"\S+@\S+\.org", "[EMAIL]", t)))
    coder = Tokenizer.from_file(tokenizer_path())
    return {i: coder.encode(t, add_special_tokens=False).ids for i, t in clean}


def test_whole_pipeline_equals_plain_code(spark, tmp_path):
    rng = random.Random(3)
    vocabulary = {"en": [f"the{x}ing" for x in "abcdefghijklmnop"], "de": [f"ge{x}ung" for x in "abcdefghijklmnop"]}

    def prose(lang, n):
        return " ".join(rng.choice(vocabulary[lang]) + rng.choice("aeiou") for _ in range(n))

    rows = [(i, prose("en" if i % 2 else "de", rng.randint(40, 160)), "en" if i % 2 else "de") for i in range(60)]
    item = " ".join(f"question{k}" for k in range(20))
    rows += [(100 + i, rows[i][1], rows[i][2]) for i in range(0, 20, 3)]  # copies
    rows += [(130 + i, rows[i][1].upper(), rows[i][2]) for i in range(1, 20, 6)]
    rows += [(200, prose("en", 30) + " " + item + " " + prose("en", 30), "en"), (201, item, "en")]
    rows += [(300 + i, prose("en", 50) + f" write to jo{i}@site.org today", "en") for i in range(5)]
    rows += [(400, None, "en"), (401, "", None), (402, "123 456 !!!", "en"), (403, prose("de", 4000), None)]
    docs = [(i, t, lang, "s", len(t or "")) for i, t, lang in rows]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        str(tmp_path / "documents.parquet")
    )
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    want = _plain_pipeline([(i, t) for i, t, _ in rows], [item])
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in out}
    assert len(out) == len(want) and not {200, 201, 400, 401, 402} & set(want) and len(want) < 75
    assert got == want


def test_sliced_keeps_all_rows():
    texts = ["ab", None, "", "c" * 50, "d", "é" * 5, None]
    batch = pa.RecordBatch.from_pydict({"n": range(len(texts)), "text": pa.array(texts, pa.string())})
    parts = list(tokens.sliced([batch, batch.slice(2), batch.slice(0, 0)], limit=12))
    assert pa.Table.from_batches(parts).to_pylist() == [*batch.to_pylist(), *batch.slice(2).to_pylist()]
    sizes = [[len((t or "").encode()) for t in p.column("text").to_pylist()] for p in parts]
    assert all(sum(s) <= 12 or len(s) == 1 for s in sizes) and len(parts) < 2 * len(texts) - 2


def test_batches_are_never_python_objects_as_a_whole(spark, monkeypatch):
    """A batch of 64 MB of texts takes far less than its own size beside it."""
    made = []
    taken = lambda self, run, schema: made.append(run) or spark.createDataFrame([], schema)
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    model = langid.Model(("en", "fr"), (langid.Machine("en", "fr", 0.0, np.zeros(1 << 18, "<f4")),))
    monkeypatch.setattr(type(docs), "mapInArrow", taken)
    langid.predict(docs, model)
    decontaminate.candidate_segments(docs, np.zeros(16, np.uint64), 3, decontaminate.MASKS)
    monkeypatch.undo()
    n = 1000
    text = pa.array(["word and more " * 4700] * n, pa.string())
    ids = pa.array(range(n), pa.int64())
    columns = {"key": ids, "doc_id": ids, "text": text, "text_bytes": text.cast(pa.binary())}
    none = pa.nulls(n, pa.string())
    batch = pa.RecordBatch.from_pydict(columns | {"lang": none, "source": none, "n_chars": ids})
    assert text.nbytes > 64e6
    for run, least in zip(made, (n, 0), strict=True):
        tracemalloc.start()
        rows = sum(b.num_rows for b in run(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert rows == least and peak < 100e6, (run, rows, peak)
