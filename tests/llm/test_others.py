import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.llm import chat, langid, licences, sharding
from ledgerlens.llm.queries import held_out

from .conftest import SMOKE


# --- sharding

@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 1000), max_size=40), st.integers(2, 6))
def test_differencing_follows_the_definition(weights, k):
    """Against a plain version that carries the subsets themselves."""
    import heapq
    slots = sharding.differencing(np.array(weights, np.int64), k)
    assert len(slots) == len(weights) and all(0 <= s < k for s in slots)
    heap = [(-w, i, [(w, [i])] + [(0, [])] * (k - 1)) for i, w in enumerate(weights)]
    heapq.heapify(heap)
    nth = len(weights)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        both = sorted(((x + y, m + n) for (x, m), (y, n) in zip(a, reversed(b))), key=lambda s: -s[0])
        heapq.heappush(heap, (both[-1][0] - both[0][0], nth, both))
        nth += 1
    if heap:
        sums = np.bincount(slots, weights=weights, minlength=k)
        assert sorted(sums) == sorted(s for s, _ in heap[0][2])


def check_shards(out, rows, n):
    assert sorted(map(repr, ((r["id"], r["size"]) for r in out))) == sorted(repr((i, len((t or "").encode()) + 8)) for i, t in rows)
    slots = defaultdict(list)
    for r in out:
        assert 0 <= r["shard"] < n
        slots[r["shard"]].append(r["slot"])
    for own in slots.values():
        assert sorted(own) == list(range(len(own)))
    together = defaultdict(set)
    for r in out:
        together[(r["crc"], r["size"])].add(r["shard"])
    assert all(len(s) == 1 for s in together.values())


def test_shards_of_odd_rows(make_docs, odd_rows):
    check_shards(sharding.shard_by_bytes(make_docs(odd_rows), 4).collect(), odd_rows, 4)


def test_shards_balance_around_a_giant_group(make_docs):
    rows = [(i, "copy " * 20) for i in range(400)] + [(1000 + i, f"{i} " * (1 + i % 37)) for i in range(1500)]
    out = sharding.shard_by_bytes(make_docs(rows), 8).collect()
    check_shards(out, rows, 8)
    total = defaultdict(int)
    for r in out:
        total[r["shard"]] += r["size"]
    giant = 400 * 108
    rest = (sum(total.values()) - giant) / 7
    assert sorted(total.values())[-1] <= max(giant, sum(total.values()) / 8) * 1.01
    assert all(abs(v - rest) < 0.02 * rest for v in sorted(total.values())[:-1])


# --- chat

@settings(max_examples=300, deadline=None)
@given(st.text("<|\\>a/s\n\U0001f600", max_size=30))
def test_escaping_round_trips(text):
    out = chat.escape(text)
    assert "<|" not in out and chat.unescape(out) == text


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.text("u<|\\", max_size=6), st.text("<|\\>text|\n", max_size=20)), min_size=1, max_size=4))
def test_a_conversation_parses_back(turns):
    whole = "".join(chat.flatten(role, [chat.TextPart(text)], True)[0] for role, text in turns)
    assert [(chat.unescape(r), chat.unescape(t)) for r, t in chat.PIECE.findall(whole)] == turns


def test_typed_parts_become_placeholders(spark):
    part = "struct<type:string, text:string, ref:string, width:int, height:int, seconds:double, pages:int>"
    parts = [("text", "look <|end|>", None, None, None, None, None), ("image", None, "s3/a.png", 28, 15, None, None),
             ("text", "and hear", None, None, None, None, None), ("audio", None, "b.wav", None, None, 1.5, None),
             ("document", None, "c.pdf", None, None, None, 3)]
    rows = spark.createDataFrame([(1, 0, "assistant", parts), (1, 1, None, None)], f"conv_id long, turn long, role string, parts array<{part}>")
    first, second = sorted(chat.format_turns(rows, parts="parts").collect(), key=lambda r: r["turn"])
    assert first["piece"] == "<|turn|>assistant<|text|>look <\\|end|><|image:0|>and hear<|audio:1|><|document:2|><|end|>"
    assert first["attachments"] == ["image:s3/a.png", "audio:b.wav", "document:c.pdf"]
    assert first["attachment_tokens"] == 2 + 2 * 2 + 38 + 3 * 512
    assert [first["piece"][s:e] for s, e in zip(first["loss_start"], first["loss_end"])] == ["look <\\|end|>", "and hear"]
    assert second["piece"] == "<|turn|><|text|><|end|>" and second["attachments"] == []


def test_chat_odd_turns(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (None, 0, "user", "x"), (1, None, "system", "first"),
            (2, 0, "assistant", "<|end|>"), (2, 0, "assistant", "<|end|>"), (2, 0, "assistant", "é")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, piece string")
    out = {r["conv_id"]: r for r in chat.read_back(chat.format_turns(df)).collect()}
    assert set(out) == {1, 2, None} and out[1]["n_turns"] == 3
    assert out[1]["turns_sha256"] == hashlib.sha256("system\nfirst\nuser\n\nassistant\nb\n".encode()).hexdigest()
    assert out[2]["loss_chars"] == 15
    assert out[2]["loss_sha256"] == hashlib.sha256("<|end|><|end|>é".encode()).hexdigest()
    assert chat.read_back(chat.format_turns(df.filter("turn > 5"))).count() == 0
    whole = {r["conv"]: r["formatted"] for r in chat.conversation_text(chat.format_turns(df)).collect()}
    assert len(whole[1]) == out[1]["formatted_chars"] and whole[1].startswith("<|turn|>system")


# --- licences

def labels(make_docs, *texts):
    out = licences.scan(make_docs([(i, t) for i, t in enumerate(texts)])).collect()
    return [r for r in sorted(out, key=lambda r: r["id"])]


def test_licence_templates_are_found_in_place(make_docs):
    noise = "some words of the file before, "
    got = labels(make_docs, *[noise + text.upper() + " and after" for _, text, _ in licences.TEMPLATES])
    for r, (label, _, _) in zip(got, licences.TEMPLATES):
        assert label in r["labels"] and r["score"] == 1.0
        assert (label, len(noise.split())) in {(s["label"], s["start"]) for s in r["starts"]}


def test_licence_notices_of_one_long_file_are_all_found(make_docs):
    texts = {label: text for label, text, _ in licences.TEMPLATES}
    pairs = [("mit-grant", "gpl-grant"), ("gpl-grant", "bsd-grant"), tuple(texts)]
    files = [" and then ".join(texts[label] for label in pair) for pair in pairs]
    assert len(set(files[-1].split()) & {w for w, _ in licences.vocabulary()}) == len(licences.vocabulary()) > 32
    for r, pair, file in zip(labels(make_docs, *files), pairs, files):
        assert set(pair) <= set(r["labels"]) and r["score"] == 1.0
        starts = {(s["label"], s["start"]) for s in r["starts"]}
        assert {(label, len(file[:file.index(texts[label])].split())) for label in pair} <= starts


def test_licence_needs_the_phrase_and_the_positions(make_docs):
    shuffled, partly, gap = labels(
        make_docs, "forms binary and source in use and redistribution with permission",
        "permission is hereby granted free of charge to nobody", "released under the the mit license")
    assert shuffled["labels"] == []
    assert partly["labels"] == []  # the phrase stands, too little of the rest does
    assert "mit" in gap["labels"]


def test_base_places(make_docs):
    a, b, c, d = labels(make_docs, "mit license mit license, the Apache-License", "mitlicense mit  licenses", None, "MIT\nLICENSE é mit license")
    assert (a["n_words"], a["n_base"], a["first_word"], a["last_word"], a["base"]) == (7, 3, 0, 5, ["apache", "mit"])
    assert (b["n_base"], b["first_word"], b["last_word"], b["base"]) == (0, None, None, [])
    assert (c["n_words"], c["n_base"], c["labels"], c["score"]) == (0, 0, [], 0.0)
    assert (d["n_words"], d["n_base"], d["first_word"], d["last_word"]) == (5, 2, 0, 3)


def test_licence_odd_rows(make_docs, odd_rows):
    out = licences.scan(make_docs(odd_rows + [(30, "licenses"), (31, "!permission!")])).collect()
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    assert sorted(map(repr, ((r["id"], r["n_words"]) for r in out))) == sorted(
        repr((i, len(word.findall(lower(t))))) for i, t in odd_rows + [(30, "licenses"), (31, "!permission!")])
    assert licences.scan(make_docs([(1, "x")]).filter("doc_id > 1")).count() == 0


def test_stems_stand_in_every_phrase():
    stem = re.compile(licences.STEMS)
    assert all(stem.search(key) for _, _, key in licences.TEMPLATES)
    assert all(stem.search(p) for p in licences.BASE)


# --- language

def test_held_out_accuracy(spark):
    from pyspark.sql import functions as F
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    model = langid.train(docs.filter(~held_out(F.col("doc_id"))))
    tests = docs.filter(held_out(F.col("doc_id")))
    out = langid.identify(tests, model).join(tests.select(F.col("doc_id").alias("id"), "lang"), "id")
    right, total = out.filter("lang = lang_pred").count(), out.count()
    assert total > 20 and right >= 0.97 * total


def test_counts_and_scores_by_definition(make_docs):
    rows = [(1, "abc abd", "x"), (2, "zzz zyz", "y"), (3, "abx", None), (4, None, "x"), (5, "", "y")]
    model = langid.train(make_docs(rows))
    assert model.langs == ["x", "y"]
    counts = {"x": np.zeros(langid.BUCKETS), "y": np.zeros(langid.BUCKETS)}
    for _, t, lang in rows:
        if t and lang:
            grams, at = langid.features([t])
            for g in grams:
                np.add.at(counts[lang], g[:at[1] - 2], 1)
    for row, lang in zip(model.log, model.langs):
        c = counts[lang] + 1
        assert np.allclose(row, np.log(c / c.sum()))
    assert np.allclose(np.exp(model.prior), [2 / 5, 3 / 5])  # texts: 1 of x, 2 of y, add-one
    assert model.predict(["abab"])[0] == ["x"] and model.predict(["zzz"])[0] == ["y"]


def test_features_do_not_depend_on_neighbours():
    one, at = langid.features(["Héllo"])
    many, bounds = langid.features(["abc", "Héllo", ""])
    for a, b in zip(one, many):
        assert a[:at[1] - 2].tolist() == b[bounds[1]:bounds[2] - 2].tolist()


FOREIGN = [
    "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью.",
    "人人生而自由,在尊严和权利上一律平等。他们赋有理性和良心,并应以兄弟关系的精神相对待。",
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem.",
    "qzvx wkjq xpgf hqzt vbnk jxwq zrfp gkcv qhxz wvjb kqpx zgtf", "#a$ %%b &*c! @d# $$e %f& *g! @@h #i$ %j& *k!"]


@pytest.mark.parametrize("size", ["0.001", "0.01"])
def test_texts_in_no_learnt_language_go(spark, make_docs, size):
    docs = spark.read.parquet(f"{SMOKE.replace('0.001', size)}/documents.parquet")
    model = langid.train(docs)
    assert all(s >= 0.5 for s in model.predict(FOREIGN)[1])  # the posterior alone tells nothing
    assert langid.keep_known(make_docs(list(enumerate(FOREIGN))), model).count() == 0
    assert langid.keep_known(docs, model).count() == langid.identify(docs, model).filter("lang_pred != 'und'").count()


def test_numbers_do_not_hide_a_language(make_docs, small_texts):
    model = langid.train(make_docs([r for r in small_texts if r[2]]))
    text = next(t for _, t, lang in small_texts if lang == "en" and len(t) > 1000)[:60]
    assert model.tell([text, f"{text} 8316107434564120 4761598977407687 +1 (168) 555-5254 90210"], 0.5) == [True, True]


def test_language_of_odd_rows(make_docs, odd_rows):
    docs = make_docs(odd_rows)
    model = langid.train(docs)
    out = langid.identify(docs, model).collect()
    assert len(out) == len(odd_rows)
    by = {r["id"]: r for r in out if r["id"]}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (1, 2, 3))
    assert all(0 <= r["score"] <= 1 for r in out)
    kept = langid.keep_known(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r["lang_pred"] != "und" for r in out)
    none = langid.train(docs.filter("doc_id > 1000"))
    assert {r["lang_pred"] for r in langid.identify(docs, none).collect()} == {"und"}
    assert langid.identify(docs.filter("doc_id > 1000"), model).count() == 0


def test_turns_of_one_number_go_by_role_and_text(spark):
    """Ties are in text order, whatever the characters are written as inside a piece."""
    import hashlib
    texts = ["a\nb", "a!b", "a", "a b", "<|end|>", "<", "é", "\\", '"', "a\tb"]
    rows = [(1, 0, "user", x) for x in texts] + [(1, 0, "assistant", x) for x in texts[:4]] + [(1, 0, None, "z"), (1, None, "user", None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.read_back(chat.format_turns(turns)).collect()
    order = sorted(((-1 if t is None else t), r or "", (x or "")) for _, t, r, x in rows)
    order.sort(key=lambda k: (k[0], k[1].encode(), k[2].encode()))
    want = hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in order).encode()).hexdigest()
    learnt = hashlib.sha256("".join(x for _, r, x in order if r == "assistant").encode()).hexdigest()
    assert [(r["n_turns"], r["turns_sha256"], r["loss_sha256"]) for r in got] == [(len(rows), want, learnt)]


def test_all_notices_in_one_text(make_docs):
    notices = ". ".join(text for _, text, _ in licences.TEMPLATES)
    got = licences.scan(make_docs([(1, notices)])).collect()[0]
    assert set(got["labels"]) >= {label for label, _, _ in licences.TEMPLATES} and got["score"] == 1.0
