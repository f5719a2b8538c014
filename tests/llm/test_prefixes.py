"""Conversation trie, fingerprints and importance resampling against brute force."""

import hashlib
import heapq
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from dwelltime.llm import conversation_trie, fingerprints, importance

# Conversation trie ----------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, depth string, part int"


def trie_by_hand(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in sorted(rebuilt.items()):
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = Counter(node[:-1] for node in members if node)
    leaves, saved = Counter(), Counter()
    for node, held in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(held) - 1) * words
    out = []
    for node, held in members.items():
        ends = ",".join(str(c) for c in held if len(rebuilt[c]) == len(node))
        out.append((held[0], len(node), members[node[:-1]][0] if node else None, len(held), children[node],
                    leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return Counter(out)


def trie_rows(llm, rows, **how):
    given = llm.createDataFrame([(*row, "mine", 3) for row in rows], TURNS)
    return Counter(tuple(row) for row in conversation_trie.trie(given, **how).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect())


def shared_conversations(seed, n, long=0):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        if rng.random() < 0.05:
            continue  # families without their first conversation
        kind, length = rng.randrange(4), rng.randrange(1, 7)
        rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"turn {t if rng.random() < 0.8 else c} of {kind}")
                 for t in range(length)]
    rows += [(n + 1, t, "user", f"long {t}") for t in range(long)] + [(n + 2, t, "user", f"long {t}") for t in range(long)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("limit", [2, 7, 4096])
def test_trie_equals_brute_force_at_every_shard_size(llm, limit):
    rows = shared_conversations(limit, 150, long=90)
    assert trie_rows(llm, rows, shard_members=limit) == trie_by_hand(rows)


def test_trie_of_odd_rows(llm):
    rows = [(5, None, None, None), (5, None, "user", ""), (5, 0, "user", "a b"), (5, 0, "user", "a b"), (5, 0, "bot", "z"),
            (None, 1, "user", "nobody's"), (25, 3, "user", "x \t y\n"), (20, 0, "user", "x"), (7, 1, "user", None),
            (27, 2, None, "only"), (1000001, 0, "user", "far"), (3, 0, "us", "erx"), (23, 0, "use", "rx")]
    assert trie_rows(llm, rows) == trie_by_hand(rows)
    assert trie_rows(llm, []) == Counter()


def test_one_conversation_with_most_turns_is_dealt_over_tasks(llm):
    rows = [(40, t, "user", f"t{t % 7}") for t in range(150)] + [(c, 0, "user", f"c{c}") for c in range(60, 80)]
    given = llm.createDataFrame([(*row, "mine", 3) for row in rows], TURNS)
    llm.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = conversation_trie.numbered_turns(given).where("conv_id = 40").collect()
        assert len({r.part for r in numbered}) > 1
        assert sorted(r.place for r in numbered) == list(range(150))
        assert trie_rows(llm, rows) == trie_by_hand(rows)
    finally:
        llm.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_queue_spills_and_stays_in_order():
    rng = random.Random(5)
    queue, plain, out, expected = conversation_trie.SpillingQueue(limit=8), [], [], []
    for step in range(3000):
        if plain and rng.random() < 0.45:
            assert queue.peek() == plain[0]
            out.append(queue.pop())
            expected.append(heapq.heappop(plain))
        else:
            row = (rng.randrange(50), rng.randrange(5), step)
            queue.push(row)
            heapq.heappush(plain, row)
    while plain:
        out.append(queue.pop())
        expected.append(heapq.heappop(plain))
    assert out == expected and queue.peek() is None and len(queue.runs) > 10


# Fingerprints -----------------------------------------------------------------------------

def parse_by_hand(text):
    """Names of all levels of one text, symbol by symbol."""
    data, level, out = list(text.encode()), 0, []
    mixed = lambda x: int(fingerprints.mix(np.array([x % 2 ** 64], np.uint64))[0])
    while data:
        runs = []
        for symbol in data:
            if runs and runs[-1][0] == symbol:
                runs[-1][1] += 1
            else:
                runs.append([symbol, 1])
        symbols = [s for s, _ in runs]
        names = [((int(fingerprints._BYTE_NAMES[s]) if level == 0 else s) + (n - 1) * int(fingerprints._RUN)) % 2 ** 64
                 for s, n in runs]
        if len(symbols) == 1:
            out.append((None, mixed(names[0])))
            return out
        colour = symbols
        for _ in range(3 if level == 0 else 4):
            tossed = [colour[0] & 1]
            for before, now in zip(colour, colour[1:]):
                place = ((before ^ now) & -(before ^ now)).bit_length() - 1
                tossed.append(2 * place + (now >> place & 1))
            colour = tossed
        for high in (5, 4, 3):
            colour = [c if c != high else min({0, 1, 2} - {colour[i - 1] if i else 7, colour[i + 1] if i + 1 < len(colour) else 7})
                      for i, c in enumerate(colour)]
        assert all(a != b and a < 3 for a, b in zip(colour, colour[1:]))
        n = len(symbols)
        cuts = [0, *[i for i in range(2, n - 1) if colour[i - 1] < colour[i] > colour[i + 1]], n]
        level, data = level + 1, []
        for a, b in zip(cuts, cuts[1:]):
            name = b - a + (level << 8)
            for x in names[a:b]:
                name = (name * int(fingerprints._FOLD) + x) % 2 ** 64
            data.append(mixed(name))
        out += [(level, name) for name in data]
    return out


def features_by_hand(text):
    found = parse_by_hand(text)
    mixed = lambda x: int(fingerprints.mix(np.array([x], np.uint64))[0]) >> 32
    names = {mixed(name) for level, name in found if level and level >= fingerprints.LEVEL}
    return names or {name >> 32 for level, name in found if level is None}


def likeness_by_hand(a, b):
    a, b = (set(sorted(features_by_hand(x))[:fingerprints.SIZE]) for x in (a, b))
    first = sorted(a | b)[:fingerprints.SIZE]
    return sum(x in a and x in b for x in first) / len(first) if first else 1.0


def test_fingerprints_equal_parsing_by_hand(corpus, prose, odd):
    texts = [prose(seed, n) for seed, n in ((1, 3), (2, 40), (3, 300), (4, 900))]
    rows = [*enumerate(texts), (10, texts[2] + " " + texts[1]), (11, "aaaa bbbb" * 30), *odd, (20, texts[2])]
    found = fingerprints.fingerprints(corpus(rows)).collect()
    assert len(found) == len(rows)
    by_id = {row.doc_id: row for row in found}
    order = sorted(rows, key=lambda row: (row[0] is None, -(row[0] or 0)))
    for (i, text), (_, after) in zip(order, [*order[1:], order[0]]):
        text, after, row = text or "", after or "", by_id[i]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        assert row.n_chars == len(text)
        names = sorted(features_by_hand(text))[:fingerprints.SIZE]
        assert row.fingerprint.split(":")[1:] == (["".join(f"{x:08x}" for x in names)] if text else [])
        if i == 907:
            continue  # rows that repeat an id
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(row.near_edited - likeness_by_hand(text, edited)) < 1e-12
        assert abs(row.near_next - likeness_by_hand(text, after)) < 1e-12
    assert by_id[2].fingerprint == by_id[20].fingerprint


def test_equal_passages_have_equal_names_inside_at_any_offset(prose):
    passage = prose(8, 200)
    names = []
    for before in ("", "x", "some words before ", prose(9, 77)):
        found = list(fingerprints.phrases(pa.array([before + passage + prose(10, 5)]), np.zeros(1, np.uint64)))
        names.append({level: set(name.tolist()) for level, _, _, name in found})
    for level, share in ((1, 0.97), (2, 0.95), (3, 0.9), (4, 0.8)):
        common = set.intersection(*[n[level] for n in names])
        assert len(common) >= share * len(names[0][level])


def test_fingerprints_of_few_rows_and_of_ranges(llm, corpus, prose):
    assert fingerprints.fingerprints(corpus([])).collect() == []
    row = fingerprints.fingerprints(corpus([(1, "abcdef")])).first()
    assert row.near_next == 1.0 and row.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest()
    rows = [(i, prose(i % 40, 30)) for i in range(400)]
    out = {r.doc_id: r for r in fingerprints.fingerprints(corpus(rows).repartition(7)).collect()}
    for i, text in rows:
        half, after = len(text) // 2, rows[i - 1][1]
        assert out[i].edited_sha256 == hashlib.sha256((text[:len(text) - half] + after[:half]).encode()).hexdigest()


# Importance resampling ----------------------------------------------------------------------

def draw_by_hand(docs, target, low=1, high=1, buckets=importance.BUCKETS):
    def features(text):
        lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
        words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
        runs = [" ".join(words[i:i + k]) for k in range(low, high + 1) for i in range(len(words) - k + 1)]
        return len(words), [zlib.crc32(run.encode()) % buckets for run in runs]

    held = [(i, *features(text)) for i, text in docs]
    s, t = Counter(b for *_, f in held for b in f), Counter(b for text in target for b in features(text)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in s}
    rows = []
    for i, n, found in held:
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32))), n))
    able = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    drawn = 10 * len(able) // 100
    out = Counter((*r[:4], place + 1) for place, r in enumerate(able[:drawn]))
    return out + Counter((*r[:4], None) for r in able[drawn:]) + Counter((*r[:4], None) for r in rows if r[4] < 20)


def drawn_rows(corpus, llm, docs, target, **how):
    wanted = llm.createDataFrame([(1, text) for text in target], "item_id long, text string")
    return Counter(tuple(row) for row in importance.resample(corpus(docs), wanted, **how).select(
        "doc_id", "n_features", "weight", "score", "rank").collect())


@pytest.mark.parametrize("runs", [(1, 1), (1, 3), (2, 2)])
def test_draw_equals_brute_force(corpus, llm, prose, odd, runs):
    low, high = runs
    docs = [(i, prose(i % 70, 5 + i % 50, 60) + (" ÀB9-c" if i % 3 else "")) for i in range(150)] + odd
    docs += [(200, prose(3, 30))] * 45 + [(None, prose(4, 40))] * 20  # a hot repeated row, and many without an id
    target = [prose(900 + i, 20, 60) for i in range(8)] + [None, ""]
    assert drawn_rows(corpus, llm, docs, target, low=low, high=high) == draw_by_hand(docs, target, low, high)


def test_draw_without_documents_or_target(corpus, llm, prose):
    assert drawn_rows(corpus, llm, [], ["a"]) == Counter()
    docs = [(i, prose(i, 30)) for i in range(20)]
    assert drawn_rows(corpus, llm, docs, []) == draw_by_hand(docs, [])


def test_crc_columns_equal_the_library():
    rng = random.Random(2)
    words = [bytes(rng.randrange(256) for _ in range(rng.choice([1, 2, 3, 9, 40, 3000]))) for _ in range(200)]
    got = importance.crc_by_length(pa.array(words, pa.large_binary()))
    assert got.tolist() == [zlib.crc32(word) for word in words]
