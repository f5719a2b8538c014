"""Quality rules, personal data, pieces, language model: against brute force, libraries and held-out data."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dwelltime.llm import lm_scoring, personal_data, quality_rules, sentencepiece

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts_of(text):
    text = text or ""
    words = WORD.findall(text)
    threes = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    again = {i + k for i in range(len(words) - 2) if threes[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again),
            n < 50 or 100 * len(again) > 50 * n)


@pytest.fixture(scope="module")
def graded(corpus, prose, llm):
    """Good prose, and prose full of symbols that labels call bad."""
    rows = [(i, prose(i, 120)) for i in range(120)]
    rows += [(200 + i, " ".join(w + "###" for w in prose(500 + i, 120).split())) for i in range(60)]
    labels = [(i, 1, 0) for i in range(100)] + [(200 + i, 0, 0) for i in range(50)] + [(None, 0, 0), (5000, 0, 1)]
    return rows, llm.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_counts_and_learned_list(corpus, graded, odd):
    rows, labels = graded
    mixed = rows + odd + [(950, "a b c\n" * 30 + "x| <y>"), (951, "one two\n\n one two\none two")]
    docs = corpus(mixed)
    rules = quality_rules.learn(docs, labels)
    assert rules.rules and any(c.feature == "symbol_share" for rule in rules.rules for c in rule)
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                  for r in quality_rules.judge(docs, rules).collect())
    assert got == Counter((i, *counts_of(t)) for i, t in mixed)
    verdict = {r.doc_id: r.kept for r in quality_rules.judge(docs, rules).collect()}
    assert all(verdict[i] for i in range(120)) and not any(verdict[200 + i] for i in range(60))
    kept = quality_rules.filter_quality(docs, rules)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(range(120))


def test_no_labels_no_rules(corpus, graded):
    rows, labels = graded
    assert quality_rules.learn(corpus(rows), labels.limit(0)).rules == ()
    empty = corpus([])
    assert quality_rules.judge(empty, quality_rules.learn(empty, labels)).count() == 0


FORMS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
         "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
         "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def valid(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(int(x) <= 255 for x in hit.split("."))
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "card":
        if not 13 <= len(digits) <= 19:
            return False
        total = 0
        for i, c in enumerate(reversed(digits)):
            twice = int(c) * (2 if i % 2 else 1)
            total += twice - 9 if twice > 9 else twice
        return total % 10 == 0
    return True


def base_spans(text):
    return [f"{kind}:{m.start()}:{m.end()}" for kind, form in FORMS.items()
            for m in re.finditer(form, text or "") if valid(kind, m.group())]


def test_base_spans_are_those_of_the_plain_patterns(corpus, odd):
    rng = random.Random(11)
    rows = [(i, "".join(rng.choice(["a@b.c", "@", ".", "-", "_", " ", "+1 (", ") ", "555", "0300", "1.2.3.4", "9", "é",
                                    "4111 1111 1111 1111", "d@e", "255.", "%"]) for _ in range(25)))
            for i in range(300)]
    rows += [(500, "a@b.c_d@e.f,1.2.3.4.5.6.7.8"), (501, "1" * 3000), (502, "1 " * 3000), (503, "+1" + "(" * 2000)]
    rows += odd
    got = Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256)
                  for r in personal_data.report(corpus(rows)).collect())
    expected = Counter()
    for i, t in rows:
        spans = base_spans(t)
        kinds = Counter(s.split(":")[0] for s in spans)
        expected[(i, *[kinds[k] for k in FORMS], hashlib.sha256(",".join(spans).encode()).hexdigest())] += 1
    assert got == expected


def test_contexts_of_known_numbers_give_unknown_ones_away(corpus):
    """After "call" come numbers, most with a plus; one without it is found by its context."""
    rows = [(i, f"please call +1 (743) 555-38{i:02d} soon or write w{i}") for i in range(12)]
    rows += [(50, "please call (743) 555-9999 soon or write"), (51, "room 55555 has a door 1234567890")]
    found = {r.doc_id: r.spans for r in personal_data.report(corpus(rows), min_known=3).collect()}
    assert found[50] == "phone:12:26" and found[51] == "" and found[0].startswith("phone:12:")
    masked = {r.doc_id: r for r in personal_data.mask(corpus(rows)).collect()}
    assert masked[50].text == "please call <PHONE> soon or write" and masked[50].n_chars == len(masked[50].text)
    assert masked[51].text == rows[-1][1] and masked[0].stats == "mine"
    assert personal_data.report(corpus([])).count() == 0


def test_many_matches_in_one_text_take_linear_time(corpus):
    """A hundred thousand numbers in one text, every tenth an address: places by hand, in seconds."""
    words = [f"10.{n % 256}.{n // 256 % 256}.7" if n % 10 == 0 else f"n{n}é" for n in range(100_000)]
    text = "\U0001F600 ".join(words)
    started = time.monotonic()
    (row,) = personal_data.report(corpus([(1, text)])).collect()
    assert time.monotonic() - started < 60
    spans = base_spans(text)
    assert row.n_ip == 10_000 and row.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
    short = " \U0001F600".join(words[:40])
    masked = personal_data.mask(corpus([(1, short), (2, "clean"), (3, None)]).withColumn("_key", F.lit(77))
                                .withColumn("spans", F.lit("own")).withColumn("chars", F.lit(1.5)))
    got = {r.doc_id: r for r in masked.collect()}
    assert got[1].text == re.sub(r"10(\.[0-9]+){3}", "<IP>", short) and got[1].n_chars == len(got[1].text)
    assert (got[1]["_key"], got[1].spans, got[1].chars, got[2].text, got[3].text) == (77, "own", 1.5, "clean", None)


@pytest.fixture(scope="module")
def vocabulary():
    return sentencepiece.load()


def test_pieces_are_those_of_the_library(vocabulary, prose, odd):
    import sentencepiece as library
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(sentencepiece.MODEL, "rb") as file:
        model.ParseFromString(file.read())
    model.trainer_spec.model_type = 1
    for piece, value in zip(model.pieces, vocabulary.scores, strict=True):
        if piece.type == sentencepiece.NORMAL:
            piece.score = float(value)
    theirs = library.SentencePieceProcessor(model_proto=model.SerializeToString())
    texts = [t for _, t in odd] + ["The quick brown  fox,\n\n jumps 1234 over — ein Übermaß", "x\ty", prose(1, 20)]
    ids, at = sentencepiece.Encoder(vocabulary).encode(pa.array(texts, pa.string()))
    score = np.where(np.isin(np.arange(len(vocabulary.scores)), vocabulary.byte_ids), 0, vocabulary.scores)
    for i, text in enumerate(texts):
        own, expected = ids[at[i]:at[i + 1]], theirs.encode(text or "")
        # Ties may be cut differently where single precision adds up a whole text; the path is as good.
        assert own.tolist() == expected or np.isclose(score[own].sum(), score[expected].sum(), rtol=1e-5)


def test_texts_decode_to_themselves(corpus, llm, odd, prose):
    rows = [(i, prose(i, 50) + " ñandú\n") for i in range(20)] + odd
    encoded = sentencepiece.encode_documents(corpus(rows))
    got = encoded.collect()
    assert len(got) == len(rows)
    assert all(r.round_trip for r in got if r.doc_id != 904) and not [r for r in got if r.doc_id == 904][0].round_trip
    decoded = Counter((r.doc_id, r.text) for r in sentencepiece.decode_documents(encoded).collect())
    assert decoded == Counter((i, (t or "").replace("▁", " ")) for i, t in rows)
    strange = llm.createDataFrame([(1, None), (2, [-5, 10**6]), (3, [])], "doc_id long, ids array<int>")
    assert {r.text for r in sentencepiece.decode_documents(strange).collect()} == {""}
    assert sentencepiece.encode_documents(corpus([])).count() == 0


def test_double_array_holds_exactly_its_keys():
    rng = random.Random(4)
    keys = sorted({bytes(rng.randrange(1, 256) for _ in range(rng.randrange(1, 6))) for _ in range(400)})
    base, check, value = sentencepiece.double_array(keys, list(range(len(keys))))

    def look(key):
        state = 0
        for c in key:
            following = base[state] + c
            if check[following] != state:
                return -1
            state = following
        return value[state]

    assert [look(k) for k in keys] == list(range(len(keys)))
    assert all(look(k + b"\xff\xfe\xfd") == -1 for k in keys if k + b"\xff\xfe\xfd" not in keys)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


@pytest.mark.parametrize("head", [1 << 18, 40])
def test_base_scores_and_better_held_out_scores(corpus, odd, head):
    rng = random.Random(8)
    rows = []
    for i in range(400):  # each word says what comes next, so contexts help
        words, w = [], rng.randrange(30)
        for _ in range(40):
            words.append(f"W{w}" if rng.random() < 0.9 else f"r{rng.randrange(300)}")
            w = (w * 7 + 3) % 30
        rows.append((i, " ".join(words)))
    rows += odd
    got = lm_scoring.score(corpus(rows), head=head).collect()
    counts = Counter()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    for i, t in rows:
        if not held(i):
            counts.update([*WORD.findall(lower(t or "")), None])
    total, distinct = sum(counts.values()), len(counts)
    expected = Counter()
    for i, t in rows:
        tokens = [*WORD.findall(lower(t or "")), None]
        base = sum(math.log10((counts[x] + 1) / (total + distinct + 1)) for x in tokens)
        expected[(i, held(i), len(tokens), sum(counts[x] > 0 for x in tokens), total, round(base, 6))] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
                   for r in got) == expected
    out = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 400]
    assert sum(r.score for r in out) > sum(r.base_score for r in out) * 0.8  # at least a fifth better
    assert lm_scoring.score(corpus([])).count() == 0


def test_log_bilinear_probabilities_sum_to_one():
    model = lm_scoring.start_model(np.full(9, 1 / 9), 4)
    assert np.allclose(np.exp(model.table()).sum(axis=2), 1)


def test_contexts_of_rare_words_help_too(corpus):
    rng, rows = random.Random(3), []
    for i in range(500):  # 600 words of about one frequency; each says what comes next
        w, words = rng.randrange(600), []
        for _ in range(40):
            words.append(f"w{w}")
            w = (w * 7 + 3) % 600
        rows.append((i, " ".join(words)))
    got = [r for r in lm_scoring.score(corpus(rows)).collect() if r.held_out]
    assert sum(r.score for r in got) > sum(r.base_score for r in got) * 0.7


def test_class_factored_probabilities_sum_to_one():
    rng = np.random.default_rng(4)
    model = lm_scoring.start_model(rng.dirichlet(np.ones(21)), 4, short=3, members=5)
    for part in model.parts()[3:]:
        part[..., :-1] = rng.normal(0, 1, part[..., :-1].shape)
    found = np.exp(model.table())
    assert found.shape == (22, 22, 21) and np.allclose(found.sum(axis=2), 1, atol=1e-5)


def test_tasks_of_a_round_follow_the_training_tokens(corpus, monkeypatch):
    docs = corpus([(i, f"a{i % 7} b{i % 5} c") for i in range(100)]).repartition(12)
    asked, coalesce = [], type(docs).coalesce
    monkeypatch.setattr(type(docs), "coalesce", lambda self, n: asked.append(n) or coalesce(self, n))
    _, counts = lm_scoring.gather(docs)
    for tasks in (1, 5):
        monkeypatch.setattr(lm_scoring, "SHARD_TOKENS", -(-counts.total // tasks))
        lm_scoring.train(docs, counts, width=4, rounds=1)
    assert asked == [1, 5]


def test_every_round_reads_all_training_texts(corpus, monkeypatch):
    docs = corpus([(i, f"a{i} b{i % 5} c") for i in range(100)])
    monkeypatch.setattr(lm_scoring, "SMALL", 0, raising=False)  # a round read a part of corpora of more tokens
    read, coalesce = [], type(docs).coalesce
    monkeypatch.setattr(type(docs), "coalesce", lambda self, n: read.append(self.count()) or coalesce(self, n))
    _, counts = lm_scoring.gather(docs)
    lm_scoring.train(docs, counts, width=4)
    assert read == [sum(zlib.crc32(str(i).encode()) % 7 != 2 for i in range(100))] * 4


def test_a_task_trains_its_own_copy_of_every_part():
    rng = np.random.default_rng(3)
    model = lm_scoring.start_model(rng.dirichlet(np.ones(90)), 6, short=10, members=16)
    before = [p.copy() for p in model.parts()]
    trainer = lm_scoring.Trainer(model, (model.top[:, -1].copy(), model.own[:, :, -1].copy()), [1])
    trainer.add(*rng.integers(0, 90, (3, 2000)))
    trainer.finish()
    assert all((a == b).all() for a, b in zip(model.parts(), before, strict=True))
    assert {part for part, _, _, change in trainer.changes() if change.any()} == set(range(5))


def test_slopes_are_summed_by_row():
    rng = np.random.default_rng(2)
    rows, slopes = np.append(np.sort(rng.integers(0, 9, 50)), rng.integers(0, 12, 20)), rng.normal(size=(70, 3))
    expected = [[slopes[rows == k, j].sum() for k in range(12)] for j in range(3)]
    assert np.allclose(lm_scoring._sum_rows(12, rows, slopes), expected, atol=1e-5)
    assert np.allclose(lm_scoring._sum_runs(12, rows, slopes, 50), expected, atol=1e-5)


def test_hashes_are_found_where_a_search_finds_them():
    rng = np.random.default_rng(9)
    for n in (0, 1, 2, 300, 5000):
        held = np.unique(np.append(rng.integers(0, 1 << 64, n, np.uint64), np.uint64([0, 2**64 - 1])[:n]))
        held = np.unique(np.append(held, held[:n // 2] + np.uint64(1)))
        asked = np.concatenate([held, held + np.uint64(1), held - np.uint64(1), rng.integers(0, 1 << 64, 99, np.uint64)])
        asked = np.append(asked, np.uint64([0, 2**64 - 1]))
        at = np.searchsorted(held, asked)
        expected = np.where(np.append(held, np.uint64(0))[at] == asked, at, len(held)) if n else np.zeros(len(asked))
        expected[at == len(held)] = len(held)
        assert (lm_scoring.Finder(held)(asked) == expected).all()


def test_classes_are_contrasted_together_as_one_by_one():
    rng = np.random.default_rng(4)
    model = lm_scoring.start_model(rng.dirichlet(np.ones(90)), 6, short=10, members=16)
    model.own[:, :, :-1] = rng.normal(0, 0.3, model.own[:, :, :-1].shape)
    trainer = lm_scoring.Trainer(model, (model.top[:, -1].copy(), model.own[:, :, -1].copy()), [1])
    group = np.sort(rng.choice([0, 2, 3], 200))
    member, h = rng.integers(0, 16, 200), rng.normal(size=(200, 7)).astype(np.float32)
    trainer.rng = np.random.default_rng(5)
    slope, rows, slopes = trainer._contrast_members(h, group, member)
    other, n = np.random.default_rng(5), trainer.member_noise
    for i, g in enumerate([0, 2, 3]):
        own, noise = group == g, slice(200 + i * n, 200 + i * n + n)
        drawn = np.searchsorted(trainer.upto_own[g], other.random(n) * trainer.upto_own[g, -1])
        expected = lm_scoring._contrast(h[own], model.own[g], member[own], drawn, trainer.log_own[g])
        assert (np.concatenate([rows[:200][own], rows[noise]]) == g * 16 + expected[1]).all()
        assert np.allclose(slope[own], expected[0], atol=1e-6)
        assert np.allclose(np.concatenate([slopes[:200][own], slopes[noise]]), expected[2], atol=1e-5)


def test_every_token_has_a_slot_and_every_count_is_in_one(corpus):
    rng = random.Random(6)
    docs = corpus([(i, " ".join(f"t{int(rng.paretovariate(0.5))}" for _ in range(60))) for i in range(60)])
    table, counts = lm_scoring.gather(docs, head=200, words=50, buckets=30)
    rows = table.collect()
    code = np.array([r["code"] for r in rows]).view(np.uint64)
    slot = counts.slot(code, lm_scoring._find(counts.hashes, code))
    mass = np.bincount(slot, [r["c"] + 1 for r in rows], len(counts.mass)) + (np.arange(len(counts.mass)) >= counts.own)
    assert counts.own == 50 and len(counts.mass) == 80 and (mass == counts.mass).all()
    assert counts.mass.sum() == counts.total + counts.distinct + 30
