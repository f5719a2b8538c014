"""Near-duplicates, passages, repeated bytes, benchmark items: against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from dwelltime.llm import bag_minhash, compact_windows, components, decontaminate, run_length_index
from dwelltime.llm.arrays import Words, bags, shingles

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def bag(text):
    words = WORD.findall(text or "")
    if len(words) < 5:
        return Counter([tuple(words)] if words else [])
    return Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def similarity(a, b):
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 0


def edited(text, seed, times):
    rng, words = random.Random(seed), text.split(" ")
    for _ in range(times):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def test_signatures_agree_as_often_as_weighted_jaccard_says():
    a = " ".join(["x y z u v"] * 40 + [f"a{i}" for i in range(150)])
    b = " ".join(["x y z u v"] * 25 + [f"a{i}" for i in range(170)])
    text, _, value = shingles(Words(pa.array([a, b])))
    size = 4096
    got = bag_minhash.signatures(*bags(text, value), 2, size)
    expected = similarity(bag(a), bag(b))
    assert abs((got[0] == got[1]).mean() - expected) < 4 * (expected * (1 - expected) / size) ** 0.5


def test_components_join_chains_stars_and_loops(llm):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 130)] + [(200, 200), (301, 300)]
    links += [(rng.randrange(400, 450), rng.randrange(400, 450)) for _ in range(25)]
    got = {r.node: r.component for r in components.components(llm.createDataFrame(links, "a long, b long")).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    assert got == {x: find(x) for x in parent}
    assert components.components(llm.createDataFrame([], "a long, b long")).count() == 0


@pytest.fixture(scope="module")
def family(prose, odd):
    """A base with copies at 0.85 or so, of which two are less alike; exact copies; unrelated texts."""
    base = prose(1, 400)
    rows = [(i, edited(base, i, 7)) for i in range(12)] + [(50, base), (51, base), (52, base + " end")]
    rows += [(100 + i, prose(100 + i, 120)) for i in range(10)]
    return rows + odd


def test_near_duplicate_classes_are_those_of_brute_force(corpus, family):
    rows = [r for r in bag_minhash.classes(corpus(family)).collect()]
    texts = sorted({t or "" for _, t in family})
    held = {t: bag(t) for t in texts}
    root = {t: t for t in texts}

    def find(t):
        while root[t] != t:
            t = root[t]
        return t

    for i, a in enumerate(texts):
        for b in texts[:i]:
            if similarity(held[a], held[b]) >= 0.8:
                root[find(a)] = find(b)
    members = defaultdict(list)
    for i, t in family:
        members[find(t or "")].append(i)
    ids = {t: min((i for i in m if i is not None), default=None) for t, m in members.items()}
    expected = Counter((i, ids[find(t or "")], len(members[find(t or "")])) for i, t in family)
    assert Counter((r.doc_id, r.class_id, r.class_size) for r in rows) == expected
    kept = bag_minhash.one_of_each(corpus(family))
    assert kept.columns == corpus(family).columns
    left = [r.doc_id for r in kept.collect()]
    assert Counter(left) == Counter([ids[t] for t in members])


def test_every_class_keeps_one_document_with_or_without_ids(corpus, prose):
    a, b, c = prose(31, 90), prose(32, 90), prose(33, 90)
    rows = [(None, a), (None, a + " end"), (None, a), (7, b), (7, b + " end"), (None, b), (8, c), (None, c),
            (9, None), (9, "")]
    kept = [(r.doc_id, (r.text or "")[:20]) for r in bag_minhash.one_of_each(corpus(rows)).collect()]
    assert sorted(kept, key=str) == sorted([(None, a[:20]), (7, b[:20]), (8, c[:20]), (9, "")], key=str)


def test_a_bucket_of_unlike_texts_still_links_every_like_pair(corpus, prose):
    """One band of one row throws many texts together; leaders of all components are tried."""
    groups = [prose(s, 80) for s in range(6)]
    rows = [(10 * s + k, edited(g, k, k % 2)) for s, g in enumerate(groups) for k in range(4)]
    rows = [(i, "same head of it all " * 4 + t) for i, t in rows]
    got = {r.doc_id: r.class_id for r in bag_minhash.classes(corpus(rows), bands=40, rows=1, leaders=2).collect()}
    texts = dict(rows)
    for a in texts:
        for b in texts:
            if similarity(bag(texts[a]), bag(texts[b])) >= 0.8:
                assert got[a] == got[b]
    assert len(set(got.values())) == 6


def brute_classes(rows, threshold=0.8):
    """Class of each id by comparing every pair."""
    held = {i: {(s, k) for s, n in bag(t).items() for k in range(n)} for i, t in rows}
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(held)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            shared = len(held[i] & held[j])
            if shared and shared >= threshold * (len(held[i]) + len(held[j]) - shared):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("blocks", [dict(), dict(block_tokens=2000, block_rows=20)])
def test_two_families_hang_together_by_one_pair_that_leads_neither(corpus, prose, blocks):
    """Two families of 150 edited copies each; a text between an outer member of the one and one of the other."""
    a, b = prose(71, 300), prose(72, 300)
    rows = [(i, edited(a, i, 1 + i % 5)) for i in range(150)] + [(200 + i, edited(b, 500 + i, 1 + i % 5)) for i in range(150)]
    # From an edited copy of a, sentence by sentence, to one of b: each step is alike, both ends lead nothing.
    words, others = edited(a, 900, 7).split(" "), edited(b, 901, 7).split(" ")
    steps = [" ".join(others[:k] + words[k:]) for k in range(0, 301, 15)]
    chain = [(400 + n, text) for n, text in enumerate(steps)]
    without = [row for row in chain if row[0] != 410]
    for given in (rows + chain, rows + without) if blocks else (rows + chain,):
        got = {r.doc_id: r.class_id for r in bag_minhash.classes(corpus(given), **blocks).collect()}
        assert got == brute_classes(given)
    assert len(set(brute_classes(rows + chain).values())) < len(set(brute_classes(rows + without).values()))


def test_near_threshold_families_are_those_of_brute_force(corpus, prose):
    """Copies edited so much that many are under 0.8 to the original, of all of whom some pairs are above."""
    base = prose(81, 120)
    rows = [(i, edited(base, i, 1 + i % 5)) for i in range(220)]
    rows += [(300 + i, edited(rows[i][1], 700 + i, 1)) for i in range(0, 60, 3)]
    expected = brute_classes(rows)
    got = {r.doc_id: r.class_id for r in bag_minhash.classes(corpus(rows), block_tokens=4000).collect()}
    assert 10 < len(set(expected.values())) < 200
    differ = sum(got[i] != expected[i] for i in expected)
    assert differ <= 0.02 * len(rows)  # a pair at exactly 0.8 may share no band
    assert set(got.values()) <= set(got) and all(got[i] <= i for i in got)


def test_overlaps_of_blocks_and_of_small_groups_agree():
    rng = np.random.default_rng(9)
    sizes = rng.integers(1, 60, 90)
    token = np.concatenate([rng.choice(200, n, replace=False) for n in sizes])
    owner, held = np.repeat(np.arange(90), sizes), [set(x.tolist()) for x in np.split(token, np.cumsum(sizes)[:-1])]
    left, right = np.arange(0, 40), np.arange(40, 90)
    got = bag_minhash._overlaps_of_blocks(sizes, token, left, right)
    assert all(got[i, j] == len(held[i] & held[40 + j]) for i in range(40) for j in range(50))
    group = np.arange(90) // 30
    a, b, shared = bag_minhash._overlaps_in_groups(group, owner, token)
    expected = {(i, j): len(held[i] & held[j]) for i in range(90) for j in range(i + 1, 90) if group[i] == group[j]}
    assert dict(zip(zip(a.tolist(), b.tolist()), shared.tolist())) == {k: v for k, v in expected.items() if v}


def test_compact_windows_are_the_wide_nodes_of_the_cartesian_tree():
    rng = np.random.default_rng(5)
    for _ in range(60):
        sizes = rng.integers(0, 50, 3)
        values = np.concatenate([[0]] + [np.append(rng.integers(1, 1 << 60, n), 0) for n in sizes]).astype(np.uint64)
        least = int(rng.integers(1, 20))
        seed = np.uint64(compact_windows._SEED * 3 % (1 << 64))
        key = [int(h) >> 20 for h in compact_windows.mix(values + seed)]
        expected = set()
        for i in np.flatnonzero(values):
            a = b = i
            while values[a - 1] and key[a - 1] > key[i]:
                a -= 1
            while values[b + 1] and key[b + 1] >= key[i]:
                b += 1
            if b - a + 1 >= least:
                expected.add((a, i, b))
        assert set(zip(*map(list, compact_windows.compact_windows(values, 2, least)), strict=True)) == expected


def test_passages_that_repeat_are_found_and_others_are_not(corpus, prose, odd):
    passage = prose(77, 70)
    rows = [(i, f"{prose(i, 90)} {passage} {prose(1000 + i, 60)}") for i in range(6)]
    rows += [(20, f"{prose(20, 30)} {edited(passage, 3, 1)}"), (30, prose(30, 300)),
             (40, f"{passage} {prose(40, 80)} {passage}")]
    found = compact_windows.passages(corpus(rows + odd)).collect()
    hit = {r.doc_id for r in found} | {r.other_id for r in found}
    assert {0, 1, 2, 3, 4, 5, 20, 40} <= hit and 30 not in hit and not hit & {900, 901, 902, 903, 904, 905, None}
    texts = dict(rows)
    for r in found:
        if r.doc_id in texts and r.other_id in texts:
            a = " ".join(texts[r.doc_id].split()[r.start_word:r.end_word])
            b = " ".join(texts[r.other_id].split()[r.other_start:r.other_end])
            assert similarity(bag(a), bag(b)) >= 0.8 and min(len(a.split()), len(b.split())) >= 50
    assert compact_windows.passages(corpus([])).count() == 0


def _brute_bytes(rows):
    seen, texts = Counter(), [(i, (t or "").encode()) for i, t in rows]
    for _, b in texts:
        seen.update(b[p:p + 200] for p in range(len(b) - 199))
    out = Counter()
    for i, b in texts:
        gone = bytearray(len(b))
        for p in range(len(b) - 199):
            if seen[b[p:p + 200]] > 1:
                gone[p:p + 200] = b"\1" * 200
        runs = sum(1 for k, x in enumerate(gone) if x and (k == 0 or not gone[k - 1]))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out[(i, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest())] += 1
    return out


@pytest.fixture(scope="module")
def repetitive(prose, odd):
    shared, other = prose(5, 90), prose(6, 60)
    rows = [(i, f"{prose(200 + i, 30 + i)} {shared} {prose(300 + i, 20)}") for i in range(8)]
    rows += [(20, shared), (21, shared[3:]), (22, other + " é " + other), (23, "ab" * 300), (24, "ab" * 99),
             (25, shared[:199]), (26, f"{other[:260]}{shared[100:310]}")]
    return rows + odd


def test_repeated_bytes_are_those_of_brute_force(corpus, repetitive, monkeypatch):
    got = Counter(map(tuple, run_length_index.remove_repeats(corpus(repetitive)).collect()))
    assert got == _brute_bytes(repetitive)
    assert run_length_index.remove_repeats(corpus([])).count() == 0


def test_crowded_anchors_give_the_same_covers(repetitive, monkeypatch):
    """With blocks of three contexts the strings are hashed instead; both ways cover the same bytes."""
    rows = [(i, (t or "").encode()) for i, t in repetitive]
    found = []
    for i, (_, b) in enumerate(rows):
        data = np.frombuffer(b, np.uint8)
        place, f = run_length_index.anchors(np.array([0, len(b)]), data)
        found += [(int(g), i, max(int(p) - 100, 0), b[max(int(p) - 100, 0):int(p) + 200])
                  for p, g in zip(place, f.view(np.int64), strict=True)]
    found.sort(key=lambda x: (x[0], x[3]))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(x, k) for x, k in zip(zip(*found, strict=True), (pa.int64(), pa.int64(), pa.int32(), pa.binary()),
                                        strict=True)], ["f", "doc", "at", "context"])

    def covered(crowd):
        monkeypatch.setattr(run_length_index, "CROWD", crowd)
        out, strings = set(), defaultdict(set)
        for part in run_length_index._covers([batch]):
            for row in part.to_pylist():
                if row["code"] is None:
                    out |= {(row["doc"], k) for k in range(row["lo"], row["hi"])}
                else:
                    strings[row["code"]].add((row["doc"], row["lo"]))
        for places in strings.values():
            if len(places) > 1:
                out |= {(d, lo + k) for d, lo in places for k in range(200)}
        return out

    assert covered(10_000) == covered(3)


def test_benchmark_items_are_found_and_clean_documents_stay(corpus, prose, llm, odd):
    items = [(1, prose(61, 40)), (2, prose(62, 15)), (3, "two words"), (4, None), (5, "")]
    bench = llm.createDataFrame(items, "item_id long, text string")
    rows = [(1, f"{prose(1, 50)} {items[0][1]} {prose(2, 50)}"), (2, items[1][1].upper()),
            (3, f"{prose(3, 20)} {items[0][1][20:]}"), (4, prose(4, 200)), (5, f"{prose(5, 9)} two words"),
            (6, f"{prose(6, 9)} {edited(items[0][1], 1, 6)}"), *odd]
    got = {(r.doc_id, r.item_id): r for r in decontaminate.matches(corpus(rows), bench).collect()}
    expected = set()
    for i, t in rows:
        words = WORD.findall((t or "").lower())
        for k, item in items:
            own = WORD.findall(item or "")
            for s in range(max(1, len(words) - len(own) + 1) if own else 0):
                if similarity(bag(" ".join(words[s:s + len(own)])), bag(" ".join(own))) >= 0.8:
                    expected.add((i, k))
    assert set(got) == expected >= {(1, 1), (2, 2), (5, 3)}
    assert all(r.hamming <= decontaminate.RADIUS for r in got.values())
    kept = decontaminate.clean(corpus(rows), bench)
    assert kept.columns == corpus(rows).columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(
        str(i) for i, _ in rows if i not in {a for a, _ in expected})
    assert decontaminate.matches(corpus([]), bench).count() == 0
    assert decontaminate.matches(corpus(rows), bench.limit(0)).count() == 0


def test_items_with_moved_sentences_are_found_at_their_best_window(corpus, prose, llm):
    """All windows of all starts by brute force; halves and sentences stand in another order."""
    items = [(k, prose(70 + k, n)) for k, n in enumerate((59, 45, 40, 20))] + [(9, "one two three four five six " * 5)]
    rows = []
    for k, item in items:
        words = item.split()
        for j, cut in enumerate((len(words) // 2, 10, len(words) - 8)):
            rows.append((10 * k + j, f"{prose(k, 70)} {' '.join(words[cut:] + words[:cut])} {prose(k + 50, 70)}"))
        rows += [(10 * k + 5, " ".join(words[11:] + words[:11])), (10 * k + 6, " ".join(words[1:])),
                 (10 * k + 7, f"{prose(k, 30)} {item} {prose(k + 9, 3)} {item}")]
    bench = llm.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.start_word, r.similarity) for r in decontaminate.matches(corpus(rows), bench).collect()}
    expected = {}
    for i, t in rows:
        words = t.split()
        for k, item in items:
            n = len(item.split())
            best = max((similarity(bag(" ".join(words[s:s + n])), bag(item)), -s)
                       for s in range(max(1, len(words) - n + 1)))
            if best[0] >= 0.8:
                expected[i, k] = (-best[1], best[0])
    assert got == expected and {(0, 0), (1, 0), (10, 1), (20, 2)} <= set(got)


def test_every_fingerprint_within_the_radius_shares_a_near_block():
    rng = random.Random(9)
    for _ in range(500):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), decontaminate.RADIUS):
            b ^= 1 << bit
        assert any(((a ^ b) >> (8 * k) & 255).bit_count() <= decontaminate.SLACK for k in range(decontaminate.BLOCKS))


def _verify(left, right):
    batch = pa.RecordBatch.from_arrays(
        [pa.array([1]), pa.array([0], pa.int32()), pa.array([left]), pa.array([2]), pa.array([0], pa.int32()),
         pa.array([right]), pa.array([False])], ["doc_id", "lo", "passage", "other_id", "other_lo", "other", "same"])
    return [r for part in compact_windows._verify(0.8)(iter([batch])) for r in part.to_pylist()]


def test_one_changed_word_anywhere_keeps_a_passage(prose):
    """Brute force over all aligned intervals: one edit at each position of 50 to 100 words."""
    for n in range(50, 101, 10):
        passage = prose(n, n, 10**6).split()
        for k in range(n):
            other = passage[:k] + ["changed"] + passage[k + 1:]
            left, right = (" ".join([prose(s, 15, 10**6), *p, prose(s + 1, 15, 10**6)])
                           for s, p in ((1, passage), (5, other)))
            a, b = left.split(), right.split()
            found = _verify(left, right)
            assert len(found) == 1, (n, k)
            (r,) = found
            texts = (a[r["start_word"]:r["end_word"]], b[r["other_start"]:r["other_end"]])
            assert min(map(len, texts)) >= 50
            assert r["similarity"] == similarity(*(bag(" ".join(t)) for t in texts)) >= 0.8
            if k % 24 == 0:
                alike = [(i, j) for i in range(len(a) - 49) for j in range(i + 50, len(a) + 1)
                         if similarity(bag(" ".join(a[i:j])), bag(" ".join(b[i:j]))) >= 0.8]
                shared = {i for i in range(len(a) - 4) if tuple(a[i:i + 5]) in bag(right)}
                inside = {p for i, j in alike for p in range(i, j - 4)} & shared
                assert inside and inside <= set(range(r["start_word"], r["end_word"] - 4))


def test_verbatim_regions_are_those_the_search_gives(prose):
    """Settled by one sort or searched one by one: the same stretches."""
    rng, least = random.Random(12), 46
    pairs = []
    for n in range(120):
        passage = prose(2000 + n, rng.randrange(30, 120), 10**6)
        other = edited(passage, n, rng.choice([0, 0, 0, 1, 2]))
        twice, before = passage if n % 17 == 0 else "", rng.randrange(12)
        pairs.append((f"{prose(n, before, 10**6)} {passage} {prose(n + 1, 9, 10**6)}",
                      f"{prose(n + 5, before + (n % 13 == 0), 10**6)} {other} {twice} {prose(n + 6, 4, 10**6)}"))
    left, right = (Words(pa.array([p[k] for p in pairs])) for k in (0, 1))
    values = [compact_windows._values(words, words.hashes()) for words in (left, right)]
    text, first, last, other = compact_windows._verbatim(*values, len(pairs), least)
    held = {t: (a, b, o, o + b - a) for t, a, b, o in zip(text.tolist(), first.tolist(), last.tolist(), other.tolist())}
    assert 30 < len(held) < 110
    for t, found in held.items():
        mine, others = (v[2][v[0] == t] for v in values)
        assert compact_windows._alike(mine, others, None, 0.8, least) == [found]


def test_all_passages_of_a_region_are_given(prose):
    """Two passages with a gap, irregular edits, words put in and left out, and halves in swapped order."""
    one, two = prose(41, 70, 10**6), prose(42, 80, 10**6)
    found = _verify(f"{one} {prose(43, 45, 10**6)} {two}", f"{edited(one, 1, 1)} {prose(44, 45, 10**6)} {two}")
    assert len(found) == 2 and {r["end_word"] - r["start_word"] for r in found} <= set(range(65, 81))
    swapped = _verify(f"{one} {two}", f"{two} {one}")
    assert {(r["start_word"], r["end_word"]) for r in swapped} >= {(0, 150)}
    words = prose(45, 300, 10**6).split()
    other = words[:60] + ["more"] + words[60:130] + words[131:220] + ["and", "more"] + words[220:]
    (r,) = _verify(" ".join(words), " ".join(other))
    assert (r["start_word"], r["end_word"]) == (0, 300) and r["similarity"] == similarity(
        bag(" ".join(words)), bag(" ".join(other)))


def test_an_edited_passage_in_two_texts_is_found(corpus, prose):
    rows, pairs = [], []
    for k in range(40):
        passage = prose(500 + k, 80, 10**6).split()
        other = passage[:10 + k] + ["changed"] + passage[11 + k:]
        rows += [(2 * k, f"{prose(600 + k, 40)} {' '.join(passage)} {prose(700 + k, 40)}"),
                 (2 * k + 1, f"{prose(800 + k, 30)} {' '.join(other)} {prose(900 + k, 50)}")]
        pairs.append({2 * k, 2 * k + 1})
    hit = [{r.doc_id, r.other_id} for r in compact_windows.passages(corpus(rows)).collect()]
    assert sum(p in hit for p in pairs) >= 39 and all(p in pairs for p in hit)


def test_windows_and_links_leave_no_shuffle_files(corpus, llm, monkeypatch):
    key, kept, keep = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", [], compact_windows.keep_table
    before = llm.conf.get(key)
    monkeypatch.setattr(compact_windows, "keep_table",
                        lambda frame, label: kept.append((label, llm.conf.get(key))) or keep(frame, label))
    compact_windows.passages(corpus([(1, "one text")]))
    assert kept == [("links", "true"), ("regions", "true")] and llm.conf.get(key) == before


def test_packed_links_come_apart_as_they_were(llm):
    rows = [(-5, 7, 3 | compact_windows.COPY, 90000, 2, 2**31 - 1, -89000), (1, 2, 0, 0, 0, 0, 0), (1, 1, 4, 70, 25, 99, 600)]
    links = llm.createDataFrame(rows, compact_windows.LINK)
    packed = compact_windows._packed(links)
    assert len(packed.columns) < len(links.columns)
    apart = compact_windows._apart(packed)
    assert apart.columns == links.columns and sorted(tuple(r) for r in apart.collect()) == sorted(rows)


def test_every_edited_copy_meets_the_copies_it_is_like(corpus):
    rng, rows = random.Random(5), []
    for passage in range(3):
        base = [f"{rng.choice('bcdfgklm')}{rng.choice('aeiou')}{rng.randrange(400)}" for _ in range(60)]
        rows.append((passage * 100, " ".join(base)))
        for copy in range(1, 31):
            words = list(base)
            words[5 + rng.randrange(50)] = f"changed{copy}"
            rows.append((passage * 100 + copy, " ".join(words)))

    held = [(i, bag(text)) for i, text in rows]
    wanted = {frozenset((i, j)) for (i, x), (j, y) in combinations(held, 2) if similarity(x, y) >= 0.8}
    found = {frozenset((r.doc_id, r.other_id)) for r in compact_windows.passages(corpus(rows)).collect()}
    assert len(wanted) > 90
    assert len(wanted & found) >= 0.98 * len(wanted)  # two of five functions must agree on a pair


@pytest.mark.parametrize("batch", [1, 7, 1000])
def test_windows_of_a_large_code_are_linked_by_blocks(monkeypatch, batch):
    monkeypatch.setattr(compact_windows, "BLOCK", 4)
    rng = random.Random(batch)
    rows = sorted((code * 8, rng.randrange(size), doc, 0, 60 + rng.randrange(5), 200)
                  for code, size in enumerate([1, 2, 4, 5, 11, 1, 23]) for doc in range(size * 2))
    names = compact_windows._WINDOW_NAMES

    def batches(table, names):
        columns = [pa.array(c, pa.int64()) for c in zip(*table, strict=True)]
        whole = pa.RecordBatch.from_arrays(columns, names)
        return iter([whole.slice(at, batch) for at in range(0, whole.num_rows, batch)])

    found, left = [], []
    for part in compact_windows._links(batches(rows, names)):
        for row in part.to_pylist():
            (found if row["link"] else left).append(row["link"] or row["open"])
    blocks = Counter()
    for row in left:
        blocks[row["code"]] = max(blocks[row["code"]], row["block"] + 1)
    assert max(Counter((r["code"], r["block"]) for r in left).values()) == 4
    dealt = sorted((r["code"], min(r["block"], k), max(r["block"], k), r["block"], *[r[n] for n in names[1:]])
                   for r in left for k in range(blocks[r["code"]]))
    dealt = [(code, *rest, block, i, j) for code, i, j, block, *rest in dealt]
    for part in compact_windows._block_links(batches(dealt, [*names, "block", "i", "j"])):
        found += part.to_pylist()
    firsts = {}
    for row in rows:
        firsts.setdefault(row[:2], row)
    wanted = [(x[0], *sorted((x[2], y[2]))) for x, y in combinations(firsts.values(), 2) if x[0] == y[0]]
    copies = [(row[0], *sorted((firsts[row[:2]][2], row[2]))) for row in rows if firsts[row[:2]] is not row]
    assert sorted((r["a"], r["b"]) for r in found if not r["f"] & compact_windows.COPY) == sorted(w[1:] for w in wanted)
    assert sorted((r["a"], r["b"]) for r in found if r["f"] & compact_windows.COPY) == sorted(w[1:] for w in copies)


def test_a_text_is_read_once_for_all_that_is_asked_of_it(monkeypatch):
    monkeypatch.setattr(compact_windows, "TEXT_BYTES", 40)
    read = []
    monkeypatch.setattr(compact_windows, "Words", lambda column: read.append(len(column)) or Words(column))
    texts = [" ".join(f"{name}{k}" for k in range(30)) for name in ("ä", "b")] + [""]
    asks = [[(10 * i + k, k % 2, lo, hi) for k, (lo, hi) in enumerate([(-3, 4), (2, 2), (20, 99), (90, 95), (0, 0)])]
            for i in range(3)]
    kind = pa.list_(pa.struct({"pair": pa.int64(), "side": pa.int32(), "lo": pa.int32(), "hi": pa.int32()}))
    rows = [[dict(zip(("pair", "side", "lo", "hi"), a, strict=True)) for a in some] for some in asks]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([7, 8, 9, 9]), pa.array([texts[0], *texts]), pa.array([[], *rows], kind)], ["doc_id", "text", "asks"])
    found = [r for part in compact_windows._cut(iter([batch.slice(1)])) for r in part.to_pylist()]
    expected = [(pair, side, doc, max(lo, 0), " ".join(text.split()[max(lo, 0):hi + 5]))
                for doc, text, some in zip((8, 9, 9), texts, asks, strict=True) for pair, side, lo, hi in some]
    assert [tuple(r.values()) for r in found] == expected and read == [3]


def _links_of(texts):
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["doc", "text"])
    windows = pa.Table.from_batches(compact_windows._windows(iter([batch])))
    order = [(name, "ascending") for name in ("code", "local", "doc", "c")]
    batches = windows.sort_by(order).combine_chunks().to_batches()
    found = [r for part in compact_windows._links(iter(batches)) for r in part.to_pylist()]
    assert all(r["link"] for r in found)
    return windows.num_rows, [r["link"] for r in found]


def test_a_common_line_links_no_texts_but_a_common_passage_does(prose, monkeypatch):
    n, line, passage = 40, prose(1, 13, 10**6), prose(2, 60, 10**6)

    def around(middle, seed):
        return [f"{prose(seed + i, 60, 10**6)} {middle} {prose(seed + n + i, 60, 10**6)}" for i in range(n)]

    monkeypatch.setattr(compact_windows, "SEEN", 1)
    monkeypatch.setattr(compact_windows, "CROWD", 1)
    assert not _links_of(around(line, 100))[1]
    functions = Counter(pair[:2] for pair in {(r["a"], r["b"], r["f"]) for r in _links_of(around(passage, 300))[1]})
    assert set(functions) == set(combinations(range(n), 2)) and min(functions.values()) >= 2


def test_a_word_said_over_and_over_is_covered_by_few_rows(corpus, prose):
    texts = [f"{prose(i, 30)} {'the ' * size}{prose(50 + i, 30)}" for i, size in enumerate((400, 90, 60))]
    assert _links_of(texts)[0] < 400
    found = compact_windows.passages(corpus(list(enumerate(texts)))).collect()
    assert len(found) < 60
    covered = {i: set() for i in range(3)}
    for r in found:
        covered[r.doc_id].update(range(r.start_word, r.end_word))
        covered[r.other_id].update(range(r.other_start, r.other_end))
    for i, size in enumerate((400, 90, 60)):
        assert covered[i] >= set(range(30, 30 + size))


def test_runs_of_words_that_drifted_are_held_against_each_other(prose):
    left = f"{prose(1, 12)} {'the ' * 34}{'ering ' * 34}{prose(2, 10)}"
    found = _verify(left, f"{'the ' * 51}{'ering ' * 40}{prose(3, 10)}")
    assert {(r["start_word"], r["end_word"], r["similarity"]) for r in found} >= {(12, 80, 1.0)}
