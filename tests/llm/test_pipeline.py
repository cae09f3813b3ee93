"""The pipeline: each stage on the small table, and the whole against plain versions of its stages."""

import zlib

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from marlstone.llm.queries import vocabulary

SF = "/root/testdata/sf0.001"


def plain(rows, bench):
    """quality by the tokenizer as it comes, near duplicates by all pairs, decontamination by all windows."""
    from plain_quality import kept
    from test_decontaminate import words
    from test_ngram_join import brute as classes

    one = [r for r in rows if kept(r.text, r.lang)]
    two = [r for r, (i, c, _) in zip(one, classes([(r.doc_id, r.text) for r in one]), strict=True) if i == c]
    windows = set()
    for b in bench:
        w = words(b.text)
        n = min(10, len(w))
        windows |= {tuple(w[i : i + n]) for i in range(len(w) - n + 1) if n}
    clean = lambda w: not any(tuple(w[i : i + n]) in windows for n in {len(x) for x in windows} for i in range(len(w) - n + 1))
    return one, two, [r for r in two if clean(words(r.text))]


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = plain(docs.collect(), spark.read.parquet(f"{SF}/benchmark.parquet").collect())
    key = lambda rows: sorted(map(tuple, rows))
    kept = docs
    for (name, stage), rows in zip(corpus_pipeline.STAGES, want, strict=False):
        kept = stage(spark, kept, SF)
        assert kept.columns == docs.columns
        assert key(kept.collect()) == key(rows), name
        kept = spark.createDataFrame(rows, docs.schema)
    mixed = corpus_pipeline.mix(spark, kept, SF)
    assert mixed.columns == docs.columns
    copies = mixed.collect()
    assert {r.doc_id for r in copies} <= {r.doc_id for r in want[2]}
    from test_mixing import brute

    taken = {i: (n, k) for i, n, _, _, k in brute([(r.doc_id, r.text, r.source) for r in want[2]])}
    for i, (n, k) in taken.items():  # whole copies, as near to the words taken as they come
        assert abs(sum(r.doc_id == i for r in copies) - k / n) <= 0.5
    tokens = corpus_pipeline.token_files(spark, mixed, SF).collect()
    library = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    ids = {r.doc_id: np.array([*library.encode(r.text, add_special_tokens=False).ids, 0], np.uint32) for r in want[2]}
    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in tokens) == sorted((r.doc_id, len(ids[r.doc_id]), zlib.crc32(ids[r.doc_id].astype("<u4").tobytes())) for r in copies)
    start = 0
    for r in sorted(tokens, key=lambda r: r.start):
        assert r.start == start
        start += r.n_tokens


def test_run_and_odd_columns(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and got.count() > 0
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    odd = spark.createDataFrame([(1, None, None, None, 1, "x"), (None, "", None, None, None, None), (2, "word", "en", "s", 4, "x"), (3, long, "en", "s", None, "x"), (3, long, "en", "s", None, "x"), (3, "tie", "en", "s", 4, None), (None, long, None, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long, _node string")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, SF)
        assert out.columns == odd.columns
        out.collect()
        assert stage(spark, odd.limit(0), SF).count() == 0
