"""Shards, archives, and the pipeline."""

import base64
import hashlib
import math
from collections import Counter, defaultdict

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from dwelltime.llm import queries, sharding, warc
from dwelltime.llm.tables import table
from dwelltime.workspace import fresh_path

SF = "/root/testdata/sf0.001"


def test_shards_fit_and_only_oversized_buckets_split(corpus, prose, odd):
    rows = [(i, prose(i, 20 + i % 50)) for i in range(300)] + odd + [(7, "copy " * 30)] * 40
    limit = 3000
    got = sharding.assign(corpus(rows), limit).collect()
    assert Counter((r.doc_id, r.n_bytes) for r in got) == Counter((i, len((t or "").encode())) for i, t in rows)
    size, ids = Counter(), defaultdict(set)
    for r in got:
        size[r.shard] += r.n_bytes
        ids[r.shard].add(r.doc_id)
    assert all(n <= limit or len(ids[s]) == 1 for s, n in size.items())  # one text alone may be larger
    names = {s.split(".")[0] for s in size}
    assert all(not a.startswith(b) for a in names for b in names if a != b)
    for name in names:
        if name:
            assert sum(n for s, n in size.items() if s.startswith(name[:-1])) > limit  # its parent had to split
    assert sharding.assign(corpus([]), limit).count() == 0


def test_shards_are_written_whole(corpus, llm, prose):
    docs = corpus([(i, prose(i, 40)) for i in range(50)])
    path = fresh_path(llm, "shards")
    sharding.write_shards(docs, path, 4000)
    back = llm.read.parquet(path)
    assert back.count() == 50 and back.select("shard").distinct().count() > 1 and "stats" in back.columns


def test_rows_that_repeat_an_id_are_written_once(llm, prose):
    """Three rows of one id over the limit, and a column that is named like the folders."""
    rows = [(1, prose(1, 60), "mine", 5), (1, prose(2, 60), "own", 6), (1, prose(1, 60), "mine", 5), (2, "small", "x", 7),
            (None, None, None, None)]
    docs = llm.createDataFrame(rows, "doc_id long, text string, shard string, part int")
    path = fresh_path(llm, "shards")
    folder = sharding.write_shards(docs, path, 1000)
    back = llm.read.parquet(path)
    assert folder == "shard_" and sorted(map(str, back.select(*docs.columns).collect())) == sorted(
        map(str, docs.collect()))
    assert back.select(folder).distinct().count() >= 2


@given(st.lists(st.lists(st.integers(0, 20)), max_size=9))
@settings(max_examples=200, deadline=None)
def test_loser_tree_merges_any_number_of_runs(runs):
    assert list(warc.LoserTree([sorted(r) for r in runs])) == sorted(x for r in runs for x in r)


PAGES = [(5, "http://www.b.example.com:80/x?y=1#z", "same"), (3, "https://b.example.com/x", "same"), (9, None, "same"),
         (1, "http://a.example.org", None), (2, "not a url\r\nX: y", ""), (4, "http://[bad", "WARC/1.0\r\nWARC-Type: x\r\n\r\n"),
         (6, "http://a.example.org/é", "line\r\n\r\nWARC/1.0\r\nContent-Length: 5\r\n\r\nhello"), (7, "u", "WARC/1.0\r\n"),
         (None, "http://c.example", "same"), (None, "http://d.example", "alone"), (8, "http://a.example.org", "\r\n\r\n")]


def test_archives_give_back_every_page_and_the_index_is_in_order(llm):
    pages = llm.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, archive string")
    rows = warc.capture_index(pages).collect()
    first = {}
    for i, _, html in PAGES:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    expected = Counter()
    for i, _, html in PAGES:
        payload = (html or "").encode()
        one = first.get(html or "")
        again = one is not None and i != one
        expected[(i, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(),
                  "revisit" if again else "response", one if again else None)] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows) == expected
    keys = {r.page_id: r.url_key for r in rows}
    assert keys[5] == "com,example,b)/x?y=1" and keys[3] == "com,example,b)/x" and keys[9] == ""
    assert warc.capture_index(pages.limit(0)).count() == 0


def test_small_payloads_are_all_responses(llm):
    pages = llm.createDataFrame([(1, "a", "xx"), (2, "b", "xx"), (3, "c", "yyyy"), (4, "d", "yyyy")],
                                "page_id long, url string, html string")
    kinds = {r.page_id: r.record_type for r in warc.capture_index(pages, least_bytes=3).collect()}
    assert kinds == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_oracles_agree_with_their_queries(llm):
    db = duckdb.connect()
    db.sql(f"create view documents as select * from '{SF}/documents.parquet'")
    for name, sql in queries.ORACLES.items():
        got = queries.QUERIES[name](llm, SF)
        ours = Counter(tuple(r[c] for c in sorted(got.columns)) for r in got.collect())
        theirs = db.sql(sql)
        names = sorted(theirs.columns)
        assert names == sorted(got.columns)
        assert ours == Counter(db.sql(f"select {', '.join(names)} from ({sql})").fetchall())


def test_every_query_gives_a_row_per_document(llm):
    n = table(llm, SF, "documents").count()
    for name in ("op2_lm_scoring", "op4_personal_data", "op5_run_length_index", "op6_bag_minhash", "op10_quality_rules"):
        assert queries.QUERIES[name](llm, SF).count() == n


@pytest.fixture(scope="module")
def stages(llm):
    docs, out = table(llm, SF, "documents"), []
    for _, stage in corpus_pipeline.STAGES:
        path = fresh_path(llm, "pipeline-test")
        stage(llm, docs, SF).write.parquet(path)
        docs = llm.read.parquet(path)
        out.append(docs)
    return out


def test_pipeline_stages_keep_their_columns_and_only_drop_what_they_decide(llm, stages):
    first = table(llm, SF, "documents")
    ids = lambda frame: {r.doc_id for r in frame.select("doc_id").collect()}
    assert all(frame.columns == first.columns for frame in stages[:-1])
    left = [ids(frame) for frame in (first, *stages)]
    assert all(b <= a for a, b in zip(left, left[1:], strict=False))
    assert left[2] < left[1] < left[0] and left[4] == left[3] == left[5]
    labels = {r.doc_id: r.quality for r in table(llm, SF, "labels").collect()}
    from test_texts import counts_of

    base = {r.doc_id for r in first.collect() if counts_of(r.text)[-1]}
    good = {i for i, q in labels.items() if q == 1} - base
    assert len(good & left[1]) >= 0.98 * len(good)
    from test_removal import bag, similarity

    texts = {r.doc_id: bag(r.text) for r in stages[1].collect()}
    pairs = [(a, b) for a in texts for b in texts if a < b and texts[a].keys() & texts[b].keys()]
    assert all(similarity(texts[a], texts[b]) < 0.8 for a, b in pairs)
    assert all(r.round_trip and math.isfinite(r.n_tokens) for r in stages[-1].collect())
