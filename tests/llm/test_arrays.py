import re
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from dwelltime.llm import arrays

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\té中", max_size=30)), min_size=1, max_size=6)


@given(TEXTS)
@settings(max_examples=150, deadline=None)
def test_words_are_those_of_the_pattern(texts):
    words = arrays.Words(pa.array(texts, pa.string()))
    raw = words.data.tobytes()
    found = [raw[a:b].decode() for a, b in zip(words.starts, words.ends, strict=True)]
    assert found == [w for t in texts for w in WORD.findall(t or "")]
    assert words.counts.tolist() == [len(WORD.findall(t or "")) for t in texts]


@given(TEXTS)
@settings(max_examples=100, deadline=None)
def test_equal_words_have_equal_hashes_and_others_do_not(texts):
    words = arrays.Words(pa.array(texts, pa.string()))
    every = [w for t in texts for w in WORD.findall(t or "")]
    assert len(set(zip(every, words.hashes().tolist(), strict=True))) == len(set(every)) == len(set(words.hashes()))


@given(st.text(alphabet="ab ", max_size=40), st.text(alphabet="ab ", max_size=40))
@settings(max_examples=150, deadline=None)
def test_bag_similarity_is_the_weighted_jaccard_of_five_word_shingles(a, b):
    def bag(text):
        words = WORD.findall(text)
        if len(words) < 5:
            return Counter([tuple(words)] if words else [])
        return Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))

    x, y = bag(a), bag(b)
    union = sum((x | y).values())
    expected = sum((x & y).values()) / union if union else 0
    assert np.isclose(arrays.bag_similarity(pa.array([a]), pa.array([b]))[0], expected)


def test_hashes_do_not_depend_on_chunks(monkeypatch):
    text = pa.array([" ".join(f"w{i}" * (i % 7 + 1) for i in range(500))])
    whole = arrays.Words(text).hashes()
    monkeypatch.setattr(arrays, "CHUNK_BYTES", 37)
    assert (arrays.Words(text).hashes() == whole).all()


def test_pieces_lose_no_row():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 10, None, "", "b" * 100, "c"]})
    cut = list(arrays.pieces([batch], "text", 12))
    assert pa.Table.from_batches(cut).to_pydict() == batch.to_pydict() and len(cut) > 1
