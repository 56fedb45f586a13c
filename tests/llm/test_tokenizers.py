import hashlib
import random
import re
import string
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerlens.llm import bpe, packing, pieces, quality, token_counts
from ledgerlens.llm.pairindex import PairIndex

from .conftest import SMOKE

TRICKY = ["", " ", "  a  b ", "a\tb\n\n c  ", "<|endoftext|> x <|endoftext|>y", "<|ENDOFTEXT|> A", "▁a ▁▁ b▁ c", "a\xa0b　c\x1c d",
          "aaaaaaaaaaaa bbbbb hahahaha", "日本語 テキスト 😀😀 x", "'s it's 'll DON'T   \n", "É" * 50, "ﬁ ǅ İ ß ΑΣ Σ", "é ́a",
          "x" * 3000, "1234 12,5 a.b.c ...,!", "\x00\x01 \x7f", "<s> </s> <unk> <0x41>"]
TEXT = st.text(st.characters(codec="utf-8", exclude_characters="\r"), max_size=60) | st.text("ab '’s<|>\n 1é", max_size=40)
byte_lib = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
word_lib = Tokenizer.from_file(P.path("word_bpe_49k.json"))
piece_lib = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))


def check(texts):
    v = bpe.vocabulary(P.path("byte_bpe_50k.json"))
    for text, ids in zip(texts, v.encode(texts, pieces.Cache(v.encode_chunks))):
        want = byte_lib.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, text
        assert v.decode(np.frombuffer(ids, "<u4")) == byte_lib.decode(want, skip_special_tokens=False)
    w = packing.vocabulary(P.path("word_bpe_49k.json"))
    for text, ids in zip(texts, w.encode([t.encode() for t in texts], pieces.Cache(w.encode_chunks))):
        assert np.frombuffer(ids, w.kind).tolist() == word_lib.encode(text, add_special_tokens=False).ids, text
    cache = pieces.Cache(lambda keys: list(map(len, piece_lib.encode(keys, num_threads=1))))
    table = {"the": 1} if len(piece_lib.encode("the")) == 1 else {}
    assert token_counts._counts(texts, table, cache).tolist() == [len(piece_lib.encode(t)) for t in texts]


def test_tricky_texts():
    check(TRICKY)


@settings(max_examples=120, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=4))
def test_any_text(texts):
    check(texts)


def test_full_cache_starts_afresh():
    cache = pieces.Cache(lambda keys: [k.upper() for k in keys], entries=3)
    assert cache.values(["a", "b", "a"]) == ["A", "B", "A"]
    assert cache.values(["c", "d", "e", "f"]) == ["C", "D", "E", "F"]
    assert cache.values(["a" * 100]) == ["A" * 100] and cache.get("a" * 100) is None
    assert len(cache.young) <= 1 and len(cache.old) <= 1
    assert cache.values(["z", "z"]) == ["Z", "Z"] and cache.get("z") == "Z"


def one_word(rules, word):
    """Merge one word by always taking its lowest rank, leftmost first."""
    word = list(word)
    while True:
        found = [(rules[p][0], i) for i, p in enumerate(zip(word, word[1:])) if p in rules]
        if not found:
            return word
        i = min(found)[1]
        word[i:i + 2] = [rules[tuple(word[i:i + 2])][1]]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 5), st.integers(3, 5)), max_size=8, unique_by=lambda r: r[:2]),
       st.lists(st.lists(st.integers(0, 2), min_size=1, max_size=9), min_size=1, max_size=5))
def test_pair_index_equals_word_by_word(raw, words):
    """Also where a product takes part in an earlier rule."""
    rules = {(a, b): (rank, c) for rank, (a, b, c) in enumerate(raw)}
    flat = np.concatenate([np.array(w, np.int64) for w in words])
    got = PairIndex(rules, 6).encode(flat, np.array([len(w) for w in words]), "<u4")
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [one_word(rules, w) for w in words]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 5), st.integers(3, 5)), max_size=8, unique_by=lambda r: r[:2]),
       st.lists(st.lists(st.integers(0, 2), min_size=1, max_size=9), min_size=1, max_size=5), st.integers(1, 12))
def test_pair_index_of_few_positions_equals_word_by_word(raw, words, few):
    """Ranks with few positions, taken one by one, and those with more in the same words."""
    rules = {(a, b): (rank, c) for rank, (a, b, c) in enumerate(raw)}
    flat = np.concatenate([np.array(w, np.int64) for w in words])
    got = PairIndex(rules, 6, few).encode(flat, np.array([len(w) for w in words]), "<u4")
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [one_word(rules, w) for w in words]


def test_rare_ranks_take_no_array_step(monkeypatch):
    """Random letters use hundreds of ranks a few times each: array steps are left to the frequent ones."""
    rng, steps = random.Random(5), []
    words = [" " + "".join(rng.choices(string.ascii_lowercase, k=12)) for _ in range(300)]
    v = bpe.vocabulary(P.path(bpe.FILE))
    lookup = PairIndex.ranks_of
    monkeypatch.setattr(PairIndex, "ranks_of", lambda self, *x: steps.append(1) or lookup(self, *x))
    got = v.encode_chunks(words)
    library = Tokenizer.from_file(P.path(bpe.FILE))
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [library.encode(w, add_special_tokens=False).ids for w in words]
    assert len(steps) < 100


@settings(max_examples=200, deadline=None)
@given(st.text("aZé ²'.,!?-_7 \u0301", min_size=1, max_size=8))
def test_pretokens_are_the_pattern_s(text):
    v = bpe.vocabulary(P.path(bpe.FILE))
    assert list(v.pretokens(text)) == v.pattern.findall(text) and list(v.pretokens(" " + text)) == v.pattern.findall(" " + text)


def test_token_counts_of_odd_rows(make_docs, odd_rows):
    out = token_counts.count_tokens(make_docs(odd_rows), limit=5).collect()
    want = [(i, len((t or "").encode()), len(piece_lib.encode(t or ""))) for i, t in odd_rows]
    assert sorted(map(repr, ((r["id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in out))) == sorted(
        repr((*w, w[2] > 5)) for w in want)


def test_round_trip_of_odd_rows(make_docs, odd_rows):
    out = bpe.decode(bpe.encode(make_docs(odd_rows))).collect()
    assert sorted(map(repr, ((r["id"], r["text"], list(np.frombuffer(r["ids"], "<u4"))) for r in out))) == sorted(
        repr((i, t or "", list(np.array(byte_lib.encode(t or "", add_special_tokens=False).ids, "<u4")))) for i, t in odd_rows)


def packed(make_docs, rows, limit):
    out = packing.pack_documents(make_docs(rows), limit).collect()
    want = Counter()
    for i, t in rows:
        ids = word_lib.encode(t or "", add_special_tokens=False).ids + [0]
        for nth, lo in enumerate(range(0, len(ids), limit)):
            own = ids[lo:lo + limit]
            want[(i, nth, lo, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))] += 1
    assert Counter((r["id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == want
    bins = {}
    for r in out:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in bins.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= limit
    return len(bins), sum(r["length"] for r in out)


def test_packing_of_odd_rows(make_docs, odd_rows):
    packed(make_docs, odd_rows, 64)


def test_packing_is_tight(make_docs, small_texts):
    bins, tokens = packed(make_docs, [(i, t) for i, t, _ in small_texts], 2048)
    assert bins <= -(-tokens // 2048) + 1


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 37), max_size=60))
def test_best_fit_picks_the_tightest_bin(lengths):
    lengths = sorted(lengths, reverse=True)
    bins, offsets = packing.best_fit(lengths, 37)
    room = []
    for n, b, o in zip(lengths, bins, offsets):
        fits = [r for r in room if r >= n]
        if fits:
            assert room[b] == min(fits) and o == 37 - room[b]
        else:
            assert b == len(room) and o == 0
            room.append(37)
        room[b] -= n


def test_empty_tables(make_docs):
    none = make_docs([(1, "x")]).filter("doc_id > 1")
    assert token_counts.count_tokens(none).count() == 0
    assert bpe.decode(bpe.encode(none)).count() == 0
    assert packing.pack_documents(none).count() == 0
    assert quality.measure(none).count() == 0
    assert quality.keep_good(none).count() == 0


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    w = WORD.findall(text)
    seen = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {k for i in range(len(w) - 4) if seen[tuple(w[i:i + 5])] > 1 for k in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_quality_of_odd_rows(make_docs, odd_rows):
    rows = odd_rows + [(20, "a b c d e f " * 9), (21, "x\nx\n\n \nx y\nx"), (22, "a a a a a a b")]
    out = quality.measure(make_docs(rows)).collect()
    assert sorted(map(repr, ((r["id"], *[r[c] for c in BASE]) for r in out))) == sorted(repr((i, *base(t or ""))) for i, t in rows)
    for r in out:
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab \n#é", max_size=50), min_size=1, max_size=4))
def test_base_counts_of_any_text(texts):
    got = quality.base_counts([t.encode() for t in texts])
    lines = [quality.repeated_lines(t) for t in texts]
    rows = zip(*(got[c].tolist() if c != "n_dup_lines" else lines for c in BASE))
    assert list(rows) == [base(t) for t in texts]


@pytest.mark.parametrize("text, script, kept", [
    ("Die Verträge werden im ersten Quartal neu verhandelt, weil sich die Preise geändert haben. " * 1
     + "Ein Anhang nennt Lieferzeiten, Mengen und Ansprechpartner der Werke in Köln, Bonn und Mainz.", "Latin", True),
    ("Договор вступает в силу после подписания обеими сторонами и действует до конца следующего года без изменений", "Cyrillic", True),
    ("契約 は 両者 の 署名 後 に 発効 し 翌年 の 末 まで 有効 です 本書 に 定め の ない 事項 は 協議 します", "Han", True),
    (" ".join("ABCDEFGHIJKL"[i % 12] * 9 for i in range(12)) + " " + "q" * 400, "Latin", False),
    (" " * 40 + "abc " + " ".join("bcdefghijk"), "Latin", False)])
def test_verdict(make_docs, text, script, kept):
    r = quality.measure(make_docs([(1, text)])).first()
    assert (r["script"], r["kept"]) == (script, kept), r


def _random_words(alphabet, n=200, seed=5):
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice(alphabet) for _ in range(rnd.randint(2, 10))) for _ in range(n))


ALPHABETS = {"letters": string.ascii_lowercase, "capitals": string.ascii_uppercase, "base64": string.ascii_letters + string.digits + "+/",
             "hex": "0123456789abcdef", "digits": string.digits, "symbols": "#$%&*!@^~", "emoji": [chr(0x1F600 + i) for i in range(60)],
             "private use": [chr(0xE000 + i) for i in range(3000)],
             "letters of many scripts": [chr(i) for i in [*range(0x250, 0x3000), *range(0xA000, 0xAC00)] if chr(i).isalpha()]}


@pytest.mark.parametrize("kind", ALPHABETS)
def test_planted_noise_goes(make_docs, kind):
    r = quality.measure(make_docs([(1, _random_words(ALPHABETS[kind]))])).first()
    assert not r["base_failed"] and not r["kept"], r


def test_symbol_junk_goes_and_clean_documents_stay(spark):
    docs = [r for r in duckdb.sql(f"SELECT text FROM '{SMOKE.replace('0.001', '0.01')}/documents.parquet'").fetchall()]
    texts = [t for t, in docs if t and (m := base(t))[0] >= 10 and 100 * m[4] <= 20 * m[0]]
    fertility = quality.Fertility(P.path("piece_bpe_32k.model"))
    junk = [sum(c in "#*$%&|<>" for c in t) > 0.15 * len(t) for t in texts]
    assert sum(junk) > 20
    assert quality.judge([t.encode() for t in texts], fertility)["kept"] == [not j for j in junk]
    walls = ["@@@ ".join(t.split(" ")) for t, j in zip(texts, junk) if not j][:50]  # symbols that the base counts leave out
    assert not any(quality.judge([t.encode() for t in walls], fertility)["kept"])


@pytest.mark.parametrize("text", [
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem.",
    "Tất cả mọi người sinh ra đều được tự do và bình đẳng về nhân phẩm và quyền lợi. Mọi con người đều được tạo hoá ban cho lý trí.",
    "ყველა ადამიანი იბადება თავისუფალი და თანასწორი თავისი ღირსებითა და უფლებებით. მათ მინიჭებული აქვთ გონება და სინდისი.",
    "የሰው ልጅ ሁሉ ሲወለድ ነጻና በክብርና በመብትም እኩልነት ያለው ነው። የተፈጥሮ ማስተዋልና ሕሊና ስላለው አንዱ ሌላውን በወንድማማችነት መንፈስ መመልከት ይገባዋል።",
    "Call +1 (168) 555-5254 or write to 8316107434564120 with token 9dd3c80004c73dc9 and order number 4761598977407687 today please."])
def test_language_of_any_script_stays(make_docs, text):
    assert quality.measure(make_docs([(1, text)])).first()["kept"]


def test_measures(make_docs):
    text = "one two three four five six seven eight nine ten \U0001f980"
    r = quality.measure(make_docs([(1, text)])).first()
    ids = piece_lib.encode(text)
    share = np.array(list(Counter(ids).values())) / len(ids)
    assert r["n_tokens"] == len(ids) and r["chars_per_token"] == len(text) / len(ids)
    assert r["byte_share"] == sum(piece_lib.is_byte(i) for i in ids) / len(ids)
    assert abs(r["token_entropy"] + (share * np.log2(share)).sum()) < 1e-12


def test_digests_are_the_contract_s(make_docs):
    r = bpe.encode(make_docs([(1, "Hello world")])).first()
    want = byte_lib.encode("Hello world", add_special_tokens=False).ids
    assert hashlib.sha256(r["ids"]).hexdigest() == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()


def test_packing_keeps_large_ids_beside_null_ones(make_docs):
    rows = [(None, "one"), (2**53 + 1, "two words"), (2**53 + 3, "three more words"), (-(2**62) - 1, "four")]
    out = packing.pack_documents(make_docs(rows), 64).collect()
    assert sorted(map(str, (r["id"] for r in out))) == sorted(str(i) for i, _ in rows)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 400), max_size=12))
def test_plan_of_a_histogram_is_best_fit_of_its_pieces(histogram):
    """Equal pieces placed at once fill the bins that placing them one by one fills."""
    runs = packing.plan(histogram, 50)
    places = packing.Places(runs)
    rooms = {}
    for n in sorted(histogram, reverse=True):
        bins, offsets = places.of(np.full(histogram[n], n), np.arange(histogram[n]))
        for b, o in zip(bins.tolist(), offsets.tolist()):
            assert o == rooms.get(b, 0)  # side by side, no gap, no overlap
            rooms[b] = o + n
    assert all(r <= 50 for r in rooms.values()) and sorted(rooms) == list(range(len(rooms)))
    open_ = []
    for n in sorted(histogram, reverse=True):
        for _ in range(histogram[n]):
            fits = [i for i, r in enumerate(open_) if r >= n]
            if fits:
                open_[min(fits, key=lambda i: open_[i])] -= n
            else:
                open_.append(50 - n)
    assert sorted(open_) == sorted(50 - r for r in rooms.values())
