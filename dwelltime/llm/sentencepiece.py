"""SentencePiece encoding and decoding: Unigram Viterbi over a double-array trie of pieces, with byte fallback.

The piece file is a parameter and is read on the driver; its tables, bounded by the vocabulary, are broadcast. A
Unigram file's scores are log probabilities as they are. A BPE file only ranks its pieces; their log scores are then
those of Zipf's law over the ranks. Texts are cut where no piece can reach across (before blanks, mostly), so equal
segments are encoded once a batch, all of a batch side by side; the result is that of the whole text.

Defined results: a null text is empty and has no pieces; blanks and U+2581 are the same character, as in the file
format, so a text that holds U+2581 decodes with blanks and round_trip is false; characters without a piece become
one piece per UTF-8 byte; ids outside the vocabulary and control pieces decode to nothing; bytes that are no UTF-8
decode to U+FFFD. Other columns are ignored, repeated rows are encoded alike.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwelltime.llm.arrays import pieces as cut_batches
from dwelltime.llm.arrays import utf8

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
CACHE = 150_000
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def double_array(keys: list[bytes], values: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(base, check, value) of a trie over bytes: the child of state s by byte c is base[s] + c if check names s."""
    children: list[dict[int, int]] = [{}]
    leaf: list[int] = [-1]
    for key, number in zip(keys, values, strict=True):
        node = 0
        for c in key:
            if c not in children[node]:
                children[node][c] = len(children)
                children.append({})
                leaf.append(-1)
            node = children[node][c]
        leaf[node] = number
    size = len(children) * 2 + 1024
    base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    taken, place = bytearray(size), [0] * len(children)
    free, roomy = 1, 1  # where the search for one child's place goes on, and that for places of several
    taken[0] = 1
    for node, below in enumerate(children):  # parents come before their children
        value[place[node]] = leaf[node]
        if not below:
            continue
        first = min(below)
        at = max(free if len(below) == 1 else roomy, first + 1)
        while True:
            at = taken.find(0, at)
            if at < 0 or at + 256 >= len(taken):
                at, more = len(taken) if at < 0 else at, len(taken)
                taken.extend(bytes(more))
                base, value = np.append(base, np.zeros(more, np.int32)), np.append(value, np.full(more, -1, np.int32))
                check = np.append(check, np.full(more, -1, np.int32))
            if len(below) == 1 or not any(taken[at - first + c] for c in below):
                break
            at += 1
        if len(below) > 1:
            roomy = at
        elif first < 128:
            free = at
        base[place[node]] = at - first
        for c, child in below.items():
            place[child] = at - first + c
            taken[place[child]], check[place[child]] = 1, place[node]
    return np.append(base, np.zeros(256, np.int32)), np.append(check, np.full(256, -1, np.int32)), value


@dataclass
class Vocabulary:
    """The tables of a piece file; blanks stand for the white-space marker."""

    base: np.ndarray
    check: np.ndarray
    value: np.ndarray
    scores: np.ndarray
    unknown_score: np.float32
    byte_ids: np.ndarray
    prefix: bool
    piece_bytes: np.ndarray
    piece_at: np.ndarray
    cut_before: np.ndarray
    cut_after: np.ndarray


def load(path: str = MODEL) -> Vocabulary:
    """Reads a piece file. Files with a normalisation table or without byte fallback are refused."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    rules = model.normalizer_spec
    if rules.precompiled_charsmap or rules.remove_extra_whitespaces:
        raise ValueError("only piece files without text normalisation are supported")
    kinds, texts = [p.type for p in model.pieces], [p.piece for p in model.pieces]
    scores = np.array([p.score for p in model.pieces], np.float32)
    plain = [i for i, kind in enumerate(kinds) if kind in (NORMAL, USER)]
    if model.trainer_spec.model_type != model.trainer_spec.UNIGRAM:
        scores = zipf_scores(scores, plain)
    byte_ids = np.full(256, -1, np.int32)
    for i, kind in enumerate(kinds):
        if kind == BYTE:
            byte_ids[int(texts[i][1:-1], 16)] = i
    if (byte_ids < 0).any():
        raise ValueError("the piece file has no byte fallback")
    keys = {texts[i].replace(MARK, " ").encode(): i for i in plain}
    base, check, value = double_array(list(keys), list(keys.values()))
    raw = [bytes([int(t[1:-1], 16)]) if k == BYTE else b"" if k in (CONTROL, UNKNOWN) else t.replace(MARK, " ").encode()
           for t, k in zip(texts, kinds, strict=True)]
    before, after = np.ones(128, bool), np.ones(128, bool)
    for key in keys:
        for x, y in zip(key, key[1:], strict=False):
            if x != y:
                before[y if y < 128 else 0] &= y >= 128
                after[x if x < 128 else 0] &= x >= 128
    wide = np.zeros(256, bool)
    cut_before, cut_after = wide.copy(), wide.copy()
    cut_before[:128], cut_after[:128] = before, after
    return Vocabulary(base, check, value, scores, np.float32(scores[plain].min() - 10), byte_ids,
                      rules.add_dummy_prefix, np.frombuffer(b"".join(raw), np.uint8),
                      np.concatenate([[0], np.cumsum([len(r) for r in raw])]), cut_before, cut_after)


def zipf_scores(scores: np.ndarray, plain: list[int]) -> np.ndarray:
    """Log scores by rank: the n-th best piece has probability proportional to 1 / n."""
    order = np.array(plain)[np.argsort(-scores[plain], kind="stable")]
    out = np.zeros(len(scores), np.float32)
    out[order] = -np.log(np.arange(1, len(order) + 1)) - np.log(np.sum(1 / np.arange(1, len(order) + 1)))
    return out


def viterbi(v: Vocabulary, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """(ids, counts) of the best paths of many segments, side by side; ids of a segment follow each other.

    Paths are compared in single precision; of equal ones that whose last piece starts first is taken.
    """
    lengths = ends - starts
    order = np.argsort(-lengths, kind="stable")
    lengths, starts = lengths[order], starts[order]
    row = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1]  # place of a segment's first position
    size = int((lengths + 1).sum())
    best, back, piece = np.full(size, -np.inf, np.float32), np.zeros(size, np.int64), np.full(size, -1, np.int32)
    best[row] = 0
    head = np.array([1] * 192 + [2] * 32 + [3] * 16 + [4] * 16)  # bytes of a character by its first byte
    longest = int(lengths[0]) if len(lengths) else 0
    for p in range(longest):
        n = int(np.searchsorted(-lengths, -p, "left"))  # segments longer than p
        own = np.arange(n)[best[row[:n] + p] > -np.inf]
        if not len(own):
            continue
        here, score = row[own] + p, best[row[own] + p]
        at, left = starts[own] + p, lengths[own] - p
        width = np.minimum(head[data[at]], left)
        single = np.zeros(len(own), bool)
        who, state, d = np.arange(len(own)), np.zeros(len(own), np.int32), 0
        while len(who):
            following = v.base[state] + data[at[who] + d]
            ok = v.check[following] == state
            who, state = who[ok], following[ok]
            d += 1
            ident = v.value[state]
            ends_here = np.flatnonzero(ident >= 0)
            w, ident = who[ends_here], ident[ends_here]
            single[w[width[w] == d]] = True
            to, value = here[w] + d, score[w] + v.scores[ident]
            better = value > best[to]
            to = to[better]
            best[to], back[to], piece[to] = value[better], here[w[better]], ident[better]
            going = left[who] > d
            who, state = who[going], state[going]
        w = np.flatnonzero(~single)
        to, value = here[w] + width[w], score[w] + v.unknown_score
        better = value > best[to]
        to = to[better]
        best[to], back[to], piece[to] = value[better], here[w[better]], -1
    tracks, pos, who = [], row + lengths, np.flatnonzero(lengths)
    while len(who):
        end = pos[who]
        tracks.append((who, back[end] - row[who], end - row[who], piece[end]))
        pos[who] = back[end]
        who = who[pos[who] > row[who]]
    if not tracks:
        return np.empty(0, np.int32), np.zeros(len(order), np.int64)
    who, begin, end, ident = (np.concatenate(x) for x in zip(*tracks, strict=True))
    back_to = order[who]
    seq = np.lexsort((begin, back_to))
    back_to, begin, end, ident, at = back_to[seq], begin[seq], end[seq], ident[seq], starts[who[seq]]
    times = np.where(ident < 0, end - begin, 1)
    counts = np.bincount(back_to, times, len(order)).astype(np.int64)
    offset = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
    ident, at = np.repeat(ident, times), np.repeat(at + begin, times) + offset
    return np.where(ident < 0, v.byte_ids[data[at]], ident).astype(np.int32), counts


class Encoder:
    """Encodes columns of texts, with a bounded store of segments seen before."""

    def __init__(self, vocabulary: Vocabulary):
        self.v, self.seen = vocabulary, {}

    def segments(self, offsets: np.ndarray, data: np.ndarray):
        """(data, starts, ends, first): texts with their prefix, cut where no piece reaches across."""
        v, n = self.v, len(offsets) - 1
        mark = MARK.encode()
        if (data == mark[0]).any() and mark in (raw := data.tobytes()):
            parts = [raw[a:b].replace(mark, b" ") for a, b in zip(offsets, offsets[1:], strict=False)]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in parts])])
            data = np.frombuffer(b"".join(parts), np.uint8)
        lengths = np.diff(offsets)
        if v.prefix:  # a blank goes before every text that isn't empty
            extra = (lengths > 0).astype(np.int64)
            at = np.concatenate([[0], np.cumsum(lengths + extra)])
            out = np.full(at[-1], 0x20, np.uint8)
            keep = np.ones(at[-1], bool)
            keep[at[:-1][lengths > 0]] = False
            out[keep] = data
            data, offsets = out, at
        if len(data) == 0:
            return data, np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(n + 1, np.int64)
        cut = np.zeros(len(data), bool)
        cut[1:] = (data[1:] != data[:-1]) & (v.cut_before[data[1:]] | v.cut_after[data[:-1]])
        cut[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(cut)
        return data, starts, np.append(starts[1:], len(data)), np.searchsorted(starts, offsets)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets by text)."""
        data, starts, ends, first = self.segments(*utf8(column))
        if len(starts) == 0:
            return np.empty(0, np.int32), np.zeros(len(first), np.int64)
        parts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [
            None, pa.py_buffer(np.append(starts, ends[-1]).astype(np.int64)), pa.py_buffer(data)])
        coded = parts.dictionary_encode()
        unique, index = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
        new = [x for x in unique if x not in self.seen]
        if len(self.seen) + len(new) > CACHE:
            self.seen, new = {}, unique
        if new:
            at = np.concatenate([[0], np.cumsum([len(x) for x in new])])
            ids, counts = viterbi(self.v, np.frombuffer(b"".join(new), np.uint8), at[:-1], at[1:])
            raw, at = ids.tobytes(), 4 * np.concatenate([[0], np.cumsum(counts)])
            self.seen.update({x: raw[a:b] for x, a, b in zip(new, at.tolist(), at[1:].tolist(), strict=False)})
        coded = [self.seen[x] for x in unique]
        flat, size = np.frombuffer(b"".join(coded), np.int32), np.array([len(x) // 4 for x in coded])
        place = np.cumsum(size) - size
        times = size[index]
        upto = np.concatenate([[0], np.cumsum(times)])
        ids = flat[np.repeat(place[index] - upto[:-1], times) + np.arange(upto[-1])]
        return ids, upto[first]


def decode(v: Vocabulary, ids: np.ndarray, offsets: np.ndarray) -> tuple[bytes, np.ndarray]:
    """(bytes, offsets) of the texts that lists of ids stand for; the prefix is taken off again."""
    ids = np.where((ids < 0) | (ids >= len(v.piece_at) - 1), 0, ids)
    size = np.diff(v.piece_at)[ids]
    upto = np.concatenate([[0], np.cumsum(size)])
    out = v.piece_bytes[np.repeat(v.piece_at[ids] - upto[:-1], size) + np.arange(upto[-1])]
    at = upto[offsets]
    if v.prefix and len(out):
        head = at[:-1][(np.diff(at) > 0)]
        head = head[out[head] == 0x20]
        keep = np.ones(len(out), bool)
        keep[head] = False
        at = at - np.searchsorted(head, at)
        out = out[keep]
    return out.tobytes(), at


def _run_encode(shared, check: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        encoder = Encoder(v)
        for batch in cut_batches(batches, "text", 4 << 20):
            ids, at = encoder.encode(batch.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids))
            columns = [batch.column("doc_id"), pa.array(np.diff(at)), lists]
            names = ["doc_id", "n_tokens", "ids"]
            if check:
                decoded, to = decode(v, ids, at)
                source, own = utf8(batch.column("text"))
                source, whole, to = source.tolist(), own.tobytes(), to.tolist()
                spans = [decoded[a:b] for a, b in zip(to, to[1:], strict=False)]
                columns += [pa.array([hashlib.sha256(x).hexdigest() for x in spans]),
                            pa.array([x == whole[a:b] for x, a, b in zip(spans, source, source[1:], strict=False)])]
                names += ["decoded_sha256", "round_trip"]
            yield pa.RecordBatch.from_arrays(columns, names)
    return run


def encode_documents(docs: DataFrame, model: str = MODEL, check: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids; with check also the SHA-256 of what they decode to and whether that is the text."""
    shared = docs.sparkSession.sparkContext.broadcast(load(model))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids array<int>" + ", decoded_sha256 string, round_trip boolean" * check
    return docs.select("doc_id", "text").mapInArrow(_run_encode(shared, check), schema)


def decode_documents(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id and text of rows of doc_id and ids; null ids give an empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(load(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("ids")
            if column.null_count:
                column = pa.array([x or [] for x in column.to_pylist()], pa.list_(pa.int32()))
            at = column.offsets.to_numpy().astype(np.int64)
            flat = column.values.slice(at[0], at[-1] - at[0]).fill_null(-1).to_numpy(zero_copy_only=False)
            raw, to = decode(shared.value, flat, at - at[0])
            texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(to.tolist(), to[1:].tolist(), strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", F.col("ids").cast("array<int>")).mapInArrow(run, f"doc_id {kind}, text string")
