import re
from collections import defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from ledgerlens.llm import components, exact_dedup, langid, ngram_join, shingles

WORD = re.compile(r"[^\x20\x09-\x0D]+")
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, n):
    w = WORD.findall((text or "").translate(AZ))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())


def brute_components(rows, n, num, den):
    sets = [shingle_set(t, n) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        x, y = sets[i], sets[j]
        if x and y and den * len(x & y) >= num * len(x | y):
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(i)
    out = []
    for members in groups.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        for i in members:
            least = (min(ids) if ids else None) if sets[i] else rows[i][0]
            out.append((rows[i][0], len(sets[i]), least))
    return sorted(map(repr, out))


def got(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def test_exact_dedup_odd_rows(make_docs, odd_rows):
    rows = make_docs(odd_rows)
    out = exact_dedup.exact_dedup(rows, digest=True).collect()
    assert len(out) == len(odd_rows)
    by = defaultdict(list)
    for r in out:
        by[r["full"]].append(r)
    key = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    want = defaultdict(list)
    for i, t in odd_rows:
        want[key(t)].append((-len(t or ""), i is None, i or 0, i))
    assert sorted(len(v) for v in by.values()) == sorted(len(v) for v in want.values())
    for members in by.values():
        assert sum(r["kept"] for r in members) == 1
        assert {r["group_size"] for r in members} == {len(members)}
    keeps = sorted(map(repr, (r["keep_id"] for r in out)))
    assert keeps == sorted(repr(min(v)[3]) for v in want.values() for _ in v)


def test_exact_dedup_without_digest_decides_the_same(make_docs, odd_rows):
    rows = make_docs(odd_rows)
    cols = ["id", "keep_id", "group_size", "kept"]
    assert got(exact_dedup.exact_dedup(rows).select(*cols)) == got(exact_dedup.exact_dedup(rows, digest=True).select(*cols))


def test_drop_exact_copies_keeps_all_columns(make_docs, odd_rows):
    rows = make_docs(odd_rows)
    out = exact_dedup.drop_exact_copies(rows)
    assert out.columns == rows.columns
    assert out.count() == len({re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in odd_rows})


def test_levels_refine_by_length_then_prefix(make_docs):
    same = "p" * 300
    rows = make_docs([(1, same + "a"), (2, same + "b"), (3, same + "a"), (4, "q" * 301), (5, "short")])
    marks = {r["id"]: r["shared"] for r in exact_dedup.refined(rows, "doc_id", "text", 256, False).collect()}
    assert marks == {1: True, 2: True, 3: True, 4: False, 5: False}


@pytest.mark.parametrize("n, num", [(3, 90), (5, 80)])
def test_join_odd_rows(make_docs, odd_rows, n, num):
    assert got(ngram_join.near_duplicates(make_docs(odd_rows), n, num, 100)) == brute_components(odd_rows, n, num, 100)


def test_join_finds_all_links_of_a_large_family(make_docs):
    """Near copies of one text, more than a shingle's small size, and texts that only share a passage."""
    rng = np.random.default_rng(5)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(40):
        w = list(base)
        for j in rng.choice(120, rng.integers(0, 4), replace=False):
            w[j] = f"m{i}_{j}"
        rows.append((i, " ".join(w)))
    rows += [(100 + i, " ".join(base[20:70] + [f"o{i}_{j}" for j in range(12)])) for i in range(20)]
    rows += [(200 + i, " ".join(base[:60] + base[61 + i:])) for i in range(8)]
    assert got(ngram_join.near_duplicates(make_docs(rows), 3, 90, 100)) == brute_components(rows, 3, 90, 100)
    assert got(ngram_join.near_duplicates(make_docs(rows), 5, 80, 100)) == brute_components(rows, 5, 80, 100)


def test_join_on_real_documents(make_docs, small_texts):
    rows = [(i, t) for i, t, _ in small_texts]
    assert got(ngram_join.near_duplicates(make_docs(rows), 5, 80, 100)) == brute_components(rows, 5, 80, 100)


def test_keep_representatives(make_docs, odd_rows):
    rows = make_docs(odd_rows)
    out = ngram_join.keep_representatives(rows, 3, 90, 100)
    assert out.columns == rows.columns
    ids = {r["doc_id"] for r in out.select("doc_id").collect()}
    assert {1, 2, 3, 4, 5, 7, 9, 11, 12, 13} <= ids and 6 not in ids and 8 not in ids


def test_empty_tables(make_docs, spark):
    none = make_docs([(1, "x")]).filter("doc_id > 1")
    assert exact_dedup.exact_dedup(none).count() == 0
    assert exact_dedup.drop_exact_copies(none).count() == 0
    assert ngram_join.near_duplicates(none).count() == 0


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 102), (101, 102)], "a long, b long")
    got_ = {(r["node"], r["root"]) for r in components.components(links).collect()}
    assert got_ == {(i, 1) for i in range(2, 41)} | {(101, 100), (102, 100)}


def test_word_hashes_tell_words_apart():
    words = shingles.words_of([b"a b ab ba a", b"", b"\x00 \x00\x00"])
    h = words.hash
    assert h[0] == h[4] and len({int(x) for x in h}) == 6
    assert words.first.tolist() == [0, 5, 5, 7]


def test_suffix_filter_never_prunes_a_real_overlap():
    rng = np.random.default_rng(1)
    for _ in range(200):
        x = np.unique(rng.integers(0, 500, rng.integers(1, 200)).astype(np.uint64))
        y = np.unique(rng.integers(0, 500, rng.integers(1, 200)).astype(np.uint64))
        assert ngram_join.overlap_bound(x, y) >= len(np.intersect1d(x, y))


BASE_TEXT = " ".join(f"alpha{i} beta{i} gamma{i}" for i in range(40))
NEAR_TEXT = BASE_TEXT + " omega"
OTHER = [" ".join(f"{w}{i} x{i} y{i}" for i in range(30)) for w in ("red", "green", "blue")]


def test_near_copies_go_by_id_and_text(make_docs):
    """A near copy without an id, or with an id that another text has too, takes no other row with it."""
    rows = [(1, BASE_TEXT), (None, NEAR_TEXT), (None, OTHER[0]), (5, BASE_TEXT + " tail"), (5, OTHER[1]), (7, OTHER[2]), (7, OTHER[2]),
            (None, OTHER[0] + " end"), (9, ""), (9, ""), (None, None)]
    docs = make_docs(rows)
    got = ngram_join.keep_representatives(docs, n=5, num=80, den=100)
    assert got.columns == docs.columns
    left = [(r["doc_id"], r["text"]) for r in got.collect()]
    rest = [x for x in left if x[1] not in (OTHER[0], OTHER[0] + " end")]
    assert sorted(map(repr, rest)) == sorted(map(repr, [(1, BASE_TEXT), (5, OTHER[1]), (7, OTHER[2]), (9, ""), (9, ""), (None, None)]))
    assert len(left) - len(rest) == 1  # one of the two texts of the pair without ids


def test_exact_stage_keeps_the_longest_of_repeated_ids(make_docs):
    rows = [(1, "a b c"), (1, "a  b   c"), (1, "other"), (2, "abc"), (None, "x y"), (None, "x  y"), (None, "z"), (3, ""), (4, None), (5, "alone")]
    docs = make_docs(rows)
    got = exact_dedup.drop_exact_copies(docs)
    assert got.columns == docs.columns
    assert sorted(map(repr, [(r["doc_id"], r["text"]) for r in got.collect()])) == sorted(map(repr, [
        (1, "a  b   c"), (1, "other"), (None, "x  y"), (None, "z"), (3, ""), (5, "alone")]))


# --- arrays summed over tasks

MOST_BATCH_MB = 16


def batch_mb(batches):
    """MB of a reducer's batch of 2,000 of the largest rows."""
    return 2000 * max(len(x) for b in batches for x in b.column(b.num_columns - 1).to_pylist()) / 1e6


def test_rows_of_arrays_fill_no_large_batch():
    """A reducer gets the same piece of every task's array: what it holds must not grow with the tasks."""
    keys = pa.array(np.arange(200_000) * 7919, pa.int64())
    assert batch_mb(ngram_join._filter_chunks(iter([pa.record_batch([keys], ["key"])]))) <= MOST_BATCH_MB
    text = pa.array([" ".join(f"w{i}" for i in range(60_000))])
    assert batch_mb(ngram_join._sketch(iter([pa.record_batch([text], ["text"])]), 2)) <= MOST_BATCH_MB
    assert batch_mb(langid._count(iter([pa.record_batch([pa.array(["en"]), text], ["lang", "text"])]))) <= MOST_BATCH_MB


def test_filter_and_rarity_of_many_tasks_match_brute_force(spark):
    keys = spark.range(0, 3000, 1, 40).selectExpr("id * 1000003 - 7 AS several")
    want = np.zeros(ngram_join.FILTER_BITS, bool)
    want[ngram_join._bit_of(np.arange(3000, dtype=np.int64).view(np.uint64) * np.uint64(1000003) - np.uint64(7))] = True
    assert (np.unpackbits(ngram_join.key_filter(keys), bitorder="little").astype(bool) == want).all()
    texts = [" ".join(f"w{(i * j) % 50}" for j in range(30)) for i in range(60)]
    counts = np.zeros(ngram_join.SKETCH, np.int64)
    grams, _ = shingles.shingle_sets([t.encode() for t in texts], 2)
    np.add.at(counts, (grams & np.uint64(ngram_join.SKETCH - 1)).astype(np.int64), 1)
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(12)
    assert (ngram_join.rarity(docs, 2) == ngram_join._levels(counts)).all()
