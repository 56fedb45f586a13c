"""The pipeline against the same stages written plainly."""

import re

import corpus_pipeline
import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from ledgerlens.llm import quality

from .conftest import SMOKE
from .test_dedup_and_join import brute_components
from .test_tokenizers import base


def test_stages_and_columns(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language ID", "quality rules", "exact dedup", "n-gram Jaccard join", "best-fit packing"]


def test_pipeline_equals_plain_stages(spark, small_texts):
    rows = [(i, t) for i, t, _ in small_texts if t and any(c.isalpha() for c in t)]
    rows = [(i, t) for i, t in rows if (m := base(t))[0] >= 10 and 100 * m[4] <= 20 * m[0]]
    fertility = quality.Fertility(P.path("piece_bpe_32k.model"))
    verdicts = quality.judge([t.encode() for _, t in rows], fertility)["kept"]
    rows = [r for r, k in zip(rows, verdicts) if k]
    best = {}
    for i, t in rows:
        k = re.sub(r"[\x20\x09-\x0D]", "", t)
        best[k] = min(best.get(k, (0, i)), (-len(t), i)) if k in best else (-len(t), i)
    keep = {i for _, i in best.values()}
    rows = [r for r in rows if r[0] in keep]
    parts = [eval(x) for x in brute_components(rows, 5, 80, 100)]
    keep = {i for i, _, c in parts if i == c}
    rows = [r for r in rows if r[0] in keep]
    lib = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    lengths = {i: len(lib.encode(t, add_special_tokens=False).ids) + 1 for i, t in rows}
    got = corpus_pipeline.run(spark, SMOKE).collect()
    totals = {}
    for r in got:
        totals[r["doc_id"]] = totals.get(r["doc_id"], 0) + r["length"]
    assert totals == lengths
    assert len({r["sequence_id"] for r in got}) <= -(-int(np.sum(list(lengths.values()))) // 2048) + 1
