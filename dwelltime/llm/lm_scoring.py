"""LM scoring: a class-factored log-bilinear model trained with noise-contrastive estimation, and unigram scores.

Counts of all training tokens are gathered by Spark. Every token has a slot of the neural model, as context and as
target: the most frequent ones a slot of their own, all others share buckets by their hash, in which a token has its
smoothed share. The model predicts a word's vector from the two before it: first the word itself, if it is one of the
most frequent, or its class, then the slot within the class; both are normalised, so every token has a proper log
probability. Classes are stretches of the slots in order of their counts.

Training goes in rounds, and every round reads all training texts, of a corpus of any size: tasks train in numpy on
every token of their share, with noise drawn by the counts, and what they changed is averaged row by row, weighted with
how often a task used the row. Tasks grow in number with the tokens; a round's changes are averaged by Spark in chunks
of rows, and only the averaged model, whose size is bounded by the slots, is collected and broadcast.

Counts of tokens beyond the broadcast head are joined by shuffle, so every token is scored with its exact count.

Defined results: a null text is empty and has the end token alone; a row without an id trains; repeated rows count and
are scored each; without training documents all counts are 0. Other columns are ignored. Tokens are told apart by
64-bit hashes. A token that was never seen has a share of one in its bucket, as if seen before the smoothing of others.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwelltime.llm.arrays import Words, pieces
from dwelltime.llm.tables import keep_table, text_of

END = np.uint64(0)
HEAD = 1 << 18  # tokens whose counts are broadcast, at most
WORDS = 1 << 14  # tokens with a slot of their own, at most
BUCKETS = 1 << 14  # slots that all other tokens share, at most
SHORT = 128  # slots that are predicted without a class
MEMBERS = 256  # slots of a class
WIDTH = 24
RATE = 0.1  # of the first round
ROUNDS = 4
SHARD_TOKENS = 1 << 23  # tokens a task trains on, about; tasks, and what they send, grow with the corpus alone
STEPS = 32  # steps a task takes for a portion of its examples, about, and in a round, at least
BATCH = 1 << 15  # examples of a step, at most
PORTION = 1 << 10  # tokens that are scored together
CHUNK = 128  # rows of the model that are averaged together


def is_held_out(fold: int = 2, folds: int = 7) -> Column:
    code = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(F.pmod(code, F.lit(folds)) == fold, F.lit(False))


class Tally:
    """Sums counts by code and gives them back in bounded portions."""

    def __init__(self, limit: int = 1 << 20):
        self.limit, self.parts, self.size = limit, [], 0

    def add(self, codes: np.ndarray, counts: np.ndarray | None = None):
        codes, counts = _sums(codes, counts)
        self.parts.append((codes, counts))
        self.size += len(codes)
        if self.size > 2 * self.limit:
            self._merge()
            if self.size > self.limit:
                yield self.take()

    def _merge(self) -> None:
        codes, counts = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        self.parts = [_sums(codes, counts)]
        self.size = len(self.parts[0][0])

    def take(self) -> pa.RecordBatch:
        if self.parts:
            self._merge()
        codes, counts = self.parts[0] if self.parts else (np.empty(0, np.int64), np.empty(0, np.int64))
        self.parts, self.size = [], 0
        return pa.RecordBatch.from_arrays([pa.array(codes.view(np.int64)), pa.array(counts)], ["code", "c"])


def _sums(codes: np.ndarray, counts: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(codes)
    codes = codes[order]
    at = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])) if len(codes) else np.empty(0, np.int64)
    if counts is None:
        return codes[at], np.diff(np.append(at, len(codes)))
    return codes[at], np.add.reduceat(counts[order], at) if len(at) else np.empty(0, np.int64)


def _count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tally = Tally()
    for batch in pieces(batches, "text"):
        yield from tally.add(np.append(Words(batch.column("text"), lower=True).hashes(),
                                       np.full(batch.num_rows, END)))
    yield tally.take()


@dataclass
class Counts:
    """What scoring needs of the corpus: totals, the head's hashes (sorted) with counts and slots, all slots' counts."""

    total: int
    distinct: int
    hashes: np.ndarray
    counts: np.ndarray
    slots: np.ndarray  # of the head's tokens; -1 where it is a bucket
    own: int  # slots that belong to one token; buckets follow
    mass: np.ndarray  # summed counts of a slot, one more for each token, and one for unseen tokens in a bucket

    def slot(self, code: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Slots of tokens whose index in the head is `at`."""
        found = np.append(self.slots, -1)[at]
        shared = self.own + np.mod(code.view(np.int64), len(self.mass) - self.own)
        return np.where(found >= 0, found, shared)


def gather(docs: DataFrame, head: int = HEAD, words: int = WORDS, buckets: int = BUCKETS) -> tuple[DataFrame, Counts]:
    """(table of code and c, its summary). The head is cut at a count that leaves at most `head` tokens above it.

    Up to `words` tokens of the head have slots of their own; there is a bucket for every four of the others, up to
    `buckets`, so that the model's size is bounded and no token is without a slot.
    """
    texts = docs.where(~is_held_out()).select(text_of().alias("text"))
    counts = keep_table(texts.mapInArrow(_count_tokens, "code long, c long").groupBy("code")
                        .agg(F.sum("c").alias("c")), "counts")
    level = F.floor(F.log2("c") * 16).cast("int")
    rows = counts.groupBy(level.alias("level")).agg(F.count("*").alias("n"), F.sum("c").alias("c")).collect()
    total, distinct = sum(r["c"] for r in rows), sum(r["n"] for r in rows)
    least, taken = None, 0
    for row in sorted(rows, key=lambda r: -r["level"]):
        if taken + row["n"] > head:
            break
        least, taken = row["level"], taken + row["n"]
    top = counts.where(level >= least).toArrow() if least is not None else counts.limit(0).toArrow()
    codes = top["code"].to_numpy().astype(np.int64).view(np.uint64)
    c = top["c"].to_numpy().astype(np.int64)
    order = np.argsort(codes)
    codes, c = codes[order], c[order]
    best = np.lexsort((codes, -c))[:words]
    slots = np.full(len(codes), -1, np.int64)
    slots[best] = np.arange(len(best))
    shared = max(1, min(buckets, (distinct - len(best)) // 4))
    mass = np.append(c[best] + 1, np.ones(shared, np.int64))
    bucket = F.pmod("code", F.lit(shared))
    for row in counts.groupBy(bucket.alias("bucket")).agg(F.sum(F.col("c") + 1).alias("c")).collect():
        mass[len(best) + row["bucket"]] += row["c"]
    np.subtract.at(mass, len(best) + np.mod(codes[best].view(np.int64), shared), c[best] + 1)
    return counts, Counts(total, distinct, codes, c, slots, len(best), mass)


class Finder:
    """Places of hashes in a sorted array, through the first place of each value of their leading bits."""

    def __init__(self, sorted_codes: np.ndarray):
        self.size = len(sorted_codes)
        self.shift = np.uint64(64 - max(1, (4 * self.size).bit_length()))
        leading = (sorted_codes >> self.shift).astype(np.int64)
        self.first = np.searchsorted(leading, np.arange(1 << (64 - int(self.shift)))).astype(np.int32)
        self.codes = np.append(sorted_codes, np.uint64(2**64 - 1))

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        """Index in the sorted codes, or their number where a code is not among them."""
        at = np.take(self.first, (codes >> self.shift).astype(np.int64)).astype(np.int64)
        met = np.take(self.codes, at)
        on = np.flatnonzero((met < codes) & (at < self.size))
        while len(on):
            at[on] += 1
            on = on[(self.codes[at[on]] < codes[on]) & (at[on] < self.size)]
        at[np.take(self.codes, at) != codes] = self.size
        return at


def _find(sorted_codes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Index in the sorted codes, or their number where a code is not among them."""
    return Finder(sorted_codes)(codes)


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of all tokens, each text's end among them."""
    words = Words(column, lower=True)
    n = len(words.counts)
    ends = np.cumsum(words.counts) + np.arange(n)
    out = np.empty(len(words.text) + n, np.uint64)
    keep = np.ones(len(out), bool)
    keep[ends] = False
    out[ends], out[keep] = END, words.hashes()
    return np.repeat(np.arange(n), words.counts + 1), out


def _contexts(text: np.ndarray, word: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """The two words before each token; before a text there is `start`."""
    one, two = np.full(len(word), start), np.full(len(word), start)
    same = text[1:] == text[:-1]
    one[1:][same] = word[:-1][same]
    same = text[2:] == text[:-2]
    two[2:][same] = word[:-2][same]
    return two, one


@dataclass
class Model:
    """Log-bilinear: h = far * r[two] + near * r[one]; scores are h . q + bias, the bias being the last column of q.

    `top` holds the outputs of the first `short` slots and of the classes, `own` those of the members of each class.
    """

    r: np.ndarray
    far: np.ndarray
    near: np.ndarray
    top: np.ndarray
    own: np.ndarray
    short: int

    def parts(self) -> list[np.ndarray]:
        return [self.r, self.far, self.near, self.top, self.own]

    def places(self, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(output, class, member) of slots; the class is -1 for slots without."""
        rest = slot - self.short
        group = np.where(rest >= 0, rest // max(1, self.own.shape[1]), -1)
        return np.where(rest >= 0, self.short + group, slot), group, np.where(rest >= 0, rest % max(1, self.own.shape[1]), 0)

    def hidden(self, two: np.ndarray, one: np.ndarray) -> np.ndarray:
        h = np.ones((len(two), self.r.shape[1] + 1), self.r.dtype)
        far, near = np.take(self.r, two, axis=0), np.take(self.r, one, axis=0)
        far *= self.far
        near *= self.near
        np.add(far, near, out=h[:, :-1])
        return h

    def log_share(self, two: np.ndarray, one: np.ndarray, slot: np.ndarray) -> np.ndarray:
        """Log probabilities of slots after contexts, each normalised over all slots."""
        h, (output, group, member) = self.hidden(two, one), self.places(slot)
        room = np.empty(PORTION * max(len(self.top), self.own.shape[1]), h.dtype)
        found = _log_softmax(h, self.top, output, room)
        for rows in _runs(group):
            if (g := group[rows[0]]) >= 0:
                found[rows] += _log_softmax(np.take(h, rows, axis=0), self.own[g], member[rows], room)
        return found

    def table(self) -> np.ndarray:
        """Log probabilities [two, one, slot] of all contexts."""
        n = len(self.r)
        two, one, slot = (x.ravel() for x in np.indices((n, n, n - 1)))
        return self.log_share(two, one, slot).reshape(n, n, n - 1)


def _log_softmax(h: np.ndarray, q: np.ndarray, at: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Of every row the log probability of one output; in portions whose scores stay in one place, and in the cache."""
    out, ones = np.empty(len(at)), np.ones(len(q), q.dtype)
    for i in range(0, len(at), PORTION):
        own = at[i:i + PORTION]
        scores = room[:len(own) * len(q)].reshape(len(own), len(q))
        np.matmul(h[i:i + PORTION], q.T, out=scores)
        if (top := scores.max()) > 60:  # exponentials might run over
            scores -= scores.max(axis=1, keepdims=True)
        elif top < -60:
            scores -= top
        picked = scores[np.arange(len(own)), own]
        out[i:i + PORTION] = picked - np.log(np.exp(scores, out=scores) @ ones)
    return out


def _runs(key: np.ndarray) -> list[np.ndarray]:
    """The indices of each value of the key, which is small."""
    order = np.argsort(key.astype(np.int16), kind="stable")
    return np.split(order, np.flatnonzero(np.diff(key[order])) + 1) if len(order) else []


def start_model(share: np.ndarray, width: int, short: int = SHORT, members: int = MEMBERS, seed: int = 7) -> Model:
    """Small random vectors of the contexts; outputs are the log shares of the slots."""
    n, rng = len(share), np.random.default_rng(seed)
    short = min(short, n)
    groups = -(-(n - short) // members)
    padded = np.zeros(groups * members)
    padded[:n - short] = share[short:]
    padded = padded.reshape(groups, members)
    mass = padded.sum(axis=1)
    top = np.zeros((short + groups, width + 1), np.float32)
    top[:, -1] = np.log(np.append(share[:short], mass))
    own = np.zeros((groups, members, width + 1), np.float32)
    own[:, :, -1] = np.log(np.maximum(padded / np.maximum(mass, 1e-300)[:, None], 1e-30))
    return Model(rng.normal(0, 0.3, (n + 1, width)).astype(np.float32), np.full(width, 0.5, np.float32),
                 np.ones(width, np.float32), top, own, short)


def _columns(part: np.ndarray) -> np.ndarray:
    """A copy in which a column's values lie side by side: sums over examples then run along memory."""
    return part.reshape(-1, part.shape[-1]).T.copy(order="C").T.reshape(part.shape)


def _rows(part: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Rows of a matrix, as columns that lie side by side."""
    out = np.empty((part.shape[1], len(at)), part.dtype)
    return np.take(part.T, at, axis=1, out=out, mode="clip").T


class Trainer:
    """Noise-contrastive estimation with Adagrad on a task's own copy of the model; noise is drawn by the shares."""

    def __init__(self, model: Model, start: tuple[np.ndarray, np.ndarray], seed: list[int], rate: float = RATE,
                 noise: int = 32, member_noise: int = 16):
        self.old, self.rng, self.rate = model, np.random.default_rng(seed), rate
        self.model = Model(*[_columns(p) for p in model.parts()], model.short)
        self.log_top, self.log_own = start
        self.upto_top, self.upto_own = (np.cumsum(np.exp(x.astype(float)), axis=-1) for x in start)
        self.noise, self.member_noise = noise, member_noise
        self.past = [np.ones(p.T.shape, np.float32) for p in _flat(self.model)]
        self.uses, self.group_uses = np.zeros(len(model.r), np.int64), np.zeros(len(model.own), np.int64)
        self.steps, self.held, self.size = 0, [], 0

    def add(self, two: np.ndarray, one: np.ndarray, slot: np.ndarray, limit: int = 1 << 20) -> None:
        """Examples; they are trained on in bounded portions, each in an order of its own."""
        for i in range(0, len(slot), limit):
            part = np.stack([two[i:i + limit], one[i:i + limit], slot[i:i + limit]]).astype(np.int32)
            self.held.append(part)
            self.size += part.shape[1]
            if self.size >= limit:
                self._pass(np.concatenate(self.held, axis=1))
                self.held, self.size = [], 0

    def finish(self) -> None:
        """Trains on what is left; few examples are passed over until there were enough steps."""
        if self.size:
            rows = np.concatenate(self.held, axis=1)
            self._pass(rows)
            while self.steps < STEPS:
                self._pass(rows)

    def _pass(self, rows: np.ndarray) -> None:
        """Steps of examples drawn at random, those of a step in order of their slot."""
        n = rows.shape[1]
        size = int(np.clip(n // STEPS, 512, BATCH))
        step = np.empty(n, np.uint16)  # there are some 32
        step[self.rng.permutation(n)] = np.arange(n) // size
        order = _order(rows[2])
        order = order[np.argsort(step[order], kind="stable")]
        rows = np.take(rows, order, axis=1)
        for i in range(0, n, size):
            self._step(*rows[:, i:i + size].astype(np.int64))

    def _step(self, two: np.ndarray, one: np.ndarray, slot: np.ndarray) -> None:
        """A step on examples in order of their slot."""
        m, self.steps = self.model, self.steps + 1
        output, group, member = m.places(slot)
        far, near = _rows(m.r, two), _rows(m.r, one)
        h = np.ones((far.shape[1] + 1, len(slot)), far.dtype).T
        np.add(far * m.far, near * m.near, out=h[:, :-1])
        drawn = np.searchsorted(self.upto_top, self.rng.random(self.noise) * self.upto_top[-1])
        slope, rows, slopes = _contrast(h, m.top, output, drawn, self.log_top)
        changes = [(3, _sum_runs(len(m.top), rows, slopes, len(slot)))]
        if (first := int(np.searchsorted(group, 0))) < len(slot):
            more, rows, slopes = self._contrast_members(h[first:], group[first:], member[first:])
            slope[first:] += more
            changes.append((4, _sum_rows(m.own.shape[0] * m.own.shape[1], rows, slopes)))
        slope, both = slope[:, :-1], np.concatenate([two, one])
        changes += [(1, np.einsum("ij,ij->j", slope, far)[:, None]), (2, np.einsum("ij,ij->j", slope, near)[:, None]),
                    (0, _sum_rows(len(m.r), both, np.concatenate([(slope * m.far).T, (slope * m.near).T], axis=1).T))]
        parts = _flat(m)
        for number, slopes in changes:
            self._change(parts[number].T, self.past[number], slopes)
        self.uses += np.bincount(both, minlength=len(self.uses))

    def _contrast_members(self, h: np.ndarray, group: np.ndarray,
                          member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """_contrast within the class of each row; rows are in order of class, and those of `own` are numbered on."""
        groups, begin, n = np.unique(group, return_index=True, return_counts=True)
        members, noise = self.model.own.shape[1], self.member_noise
        q, log_share = self.model.own.reshape(-1, h.shape[1]), self.log_own.ravel()
        chance = self.rng.random(noise * len(groups)).reshape(len(groups), noise) * self.upto_own[groups, -1:]
        drawn = np.concatenate([g * members + self.upto_own[g].searchsorted(x)
                                for g, x in zip(groups.tolist(), chance, strict=True)])
        log_noise, at = log_share + np.float32(np.log(noise)), group * members + member
        own, others = _rows(q, at), _rows(q, drawn)
        real = -1 / (1 + np.exp((h.T * own.T).sum(axis=0) - log_noise[at]))
        spans = [(slice(a, b), slice(i * noise, (i + 1) * noise))
                 for i, (a, b) in enumerate(zip(begin.tolist(), (begin + n).tolist(), strict=True))]
        # Rows lie along memory: products are taken of the transposed sides.
        here, against, noise_of = h.T, -others.T, np.repeat(np.arange(len(groups)), n)
        fake = np.empty((noise, len(h)), h.dtype)
        for some, those in spans:
            np.matmul(against[:, those].T, here[:, some], out=fake[:, some])
        for k, row in enumerate(fake):
            row += log_noise[drawn[k::noise]][noise_of]
        np.exp(fake, out=fake)
        fake += 1
        np.reciprocal(fake, out=fake)
        slope, noise_slopes = np.empty(here.shape, h.dtype), np.empty((here.shape[0], len(drawn)), h.dtype)
        for some, those in spans:
            np.matmul(others.T[:, those], fake[:, some], out=slope[:, some])
            np.matmul(here[:, some], fake[:, some].T, out=noise_slopes[:, those])
        slope += own.T * real
        self.group_uses[groups] += n
        return slope.T, np.concatenate([at, drawn]), np.concatenate([here * real, noise_slopes], axis=1).T

    def _change(self, part: np.ndarray, past: np.ndarray, slopes: np.ndarray) -> None:
        past += slopes * slopes
        slopes *= self.rate
        slopes /= np.sqrt(past)
        part -= slopes

    def changes(self) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(part, chunk, uses, changes) of the rows that were used, uses being one a row."""
        every = self.uses.sum() // 2
        uses = [self.uses, [every], [every], np.full(len(self.model.top), every),
                np.repeat(self.group_uses, self.model.own.shape[1])]
        for number, (new, old, used) in enumerate(zip(_flat(self.model), _flat(self.old), uses, strict=True)):
            used = np.asarray(used, np.float64)
            for chunk in range(0, len(new), CHUNK):
                rows = slice(chunk, chunk + CHUNK)
                if used[rows].any():
                    yield number, chunk, used[rows], (new[rows] - old[rows]) * used[rows, None]


def _order(key: np.ndarray) -> np.ndarray:
    """The order of small whole numbers, equal ones as they stand."""
    return np.argsort(key.astype(np.uint16) if key.max(initial=0) < 1 << 16 else key, kind="stable")


def _sum_rows(n: int, rows: np.ndarray, slopes: np.ndarray) -> np.ndarray:
    """Sums of the slopes of each of n rows, as columns."""
    out = np.zeros((slopes.shape[1], n), np.float32)
    for upto, column in zip(out, slopes.T, strict=True):
        np.add.at(upto, rows, column)
    return out


def _sum_runs(n: int, rows: np.ndarray, slopes: np.ndarray, ordered: int) -> np.ndarray:
    """_sum_rows where the first rows are in order, and many of them are equal."""
    out = _sum_rows(n, rows[ordered:], slopes[ordered:])
    first = np.flatnonzero(np.append(True, rows[1:ordered] != rows[:ordered - 1]))
    out[:, rows[first]] += np.add.reduceat(slopes[:ordered].T, first, axis=1)
    return out


def _flat(model: Model) -> list[np.ndarray]:
    """The parts as matrices of rows."""
    return [p.reshape(-1, p.shape[-1]) for p in model.parts()]


def _contrast(h: np.ndarray, q: np.ndarray, at: np.ndarray, drawn: np.ndarray,
              log_share: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(slopes of h, rows of q, their slopes) of telling each row's own output from those drawn as noise."""
    log_noise, own, others = log_share + np.float32(np.log(len(drawn))), _rows(q, at), q[drawn]
    real = -1 / (1 + np.exp((h.T * own.T).sum(axis=0) - log_noise[at]))
    fake = -others @ h.T
    fake += log_noise[drawn, None]
    np.exp(fake, out=fake)
    fake += 1
    np.reciprocal(fake, out=fake)
    slope = others.T @ fake
    slope += own.T * real
    return slope.T, np.concatenate([at, drawn]), np.concatenate([h.T * real, h.T @ fake.T], axis=1).T


def _mean_changes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Changes in order of (part, chunk): their mean over the tasks, row by row, weighted with the uses."""
    def out(key: tuple, used: np.ndarray, change: np.ndarray) -> pa.RecordBatch:
        mean = change.reshape(len(used), -1) / np.maximum(used, 1)[:, None]
        return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()),
                                           pa.array([mean.astype(np.float32).tobytes()])], ["part", "chunk", "change"])

    open_key = used = change = None
    for batch in batches:
        for part, chunk, uses, changed in zip(*(batch.column(x).to_pylist() for x in (
                "part", "chunk", "uses", "change")), strict=True):
            uses, changed = np.frombuffer(uses), np.frombuffer(changed, np.float32).astype(float)
            if (part, chunk) != open_key:
                if open_key:
                    yield out(open_key, used, change)
                open_key, used, change = (part, chunk), uses, changed
            else:
                used, change = used + uses, change + changed
    if open_key:
        yield out(open_key, used, change)


def train(docs: DataFrame, counts: Counts, width: int = WIDTH, rounds: int = ROUNDS) -> Model | None:
    """Rounds of local training over all training texts, and averaging; None without training tokens."""
    if counts.total == 0:
        return None
    model, context = start_model(counts.mass / counts.mass.sum(), width), docs.sparkSession.sparkContext
    start = model.top[:, -1].copy(), model.own[:, :, -1].copy()
    texts = docs.where(~is_held_out()).select(text_of().alias("text"))
    shards = -(-counts.total // SHARD_TOKENS)
    for number in range(rounds):
        shared = context.broadcast((counts, model, start))

        def run(batches: Iterator[pa.RecordBatch], shared=shared, number=number) -> Iterator[pa.RecordBatch]:
            counts, model, start = shared.value
            task = TaskContext.get().partitionId()
            trainer, find = Trainer(model, start, [number, task], RATE / (1 + number) ** 0.5), Finder(counts.hashes)
            for batch in pieces(batches, "text"):
                text, code = _tokens(batch.column("text"))
                slot = counts.slot(code, find(code))
                trainer.add(*_contexts(text, slot, len(counts.mass)), slot)
            trainer.finish()
            if trainer.steps:
                for part, chunk, uses, change in trainer.changes():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part], pa.int32()), pa.array([chunk], pa.int32()), pa.array([task], pa.int32()),
                         pa.array([uses.tobytes()]), pa.array([change.astype(np.float32).tobytes()])],
                        ["part", "chunk", "task", "uses", "change"])

        found = texts.coalesce(shards).mapInArrow(run, "part int, chunk int, task int, uses binary, change binary")
        rows = (found.repartition("part", "chunk").sortWithinPartitions("part", "chunk", "task")
                .mapInArrow(_mean_changes, "part int, chunk int, change binary").collect())  # the model's size
        parts = _flat(model)
        for row in rows:
            part = parts[row["part"]][row["chunk"]:row["chunk"] + CHUNK]
            part += np.frombuffer(row["change"], np.float32).reshape(part.shape)
        shared.unpersist()
    return model


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, model = shared.value
        number, task, find = 0, TaskContext.get().partitionId() << 40, Finder(counts.hashes)
        log_count = np.append(np.log10(counts.counts + 1), 0.0)
        # In a bucket a token has its share; the count of one that is not of the head is added by the join.
        log_mass = np.where(np.arange(len(counts.mass)) < counts.own, 0.0, np.log10(counts.mass))
        for batch in pieces(batches, "text", 4 << 20):
            n = batch.num_rows
            text, code = _tokens(batch.column("text"))
            at = find(code)
            seen = at < len(counts.hashes)
            neural = np.zeros(len(code))
            if model:
                slot = counts.slot(code, at)
                two, one = _contexts(text, slot, len(counts.mass))
                neural = model.log_share(two, one, slot) / np.log(10) - log_mass[slot]
                neural += np.where(slot < counts.own, 0.0, log_count[at])
            tail = np.flatnonzero(~seen)
            order = np.lexsort((code[tail], text[tail]))
            t, c = text[tail][order], code[tail][order]
            new = np.flatnonzero(np.append(True, (t[1:] != t[:-1]) | (c[1:] != c[:-1]))) if len(t) else np.empty(0, int)
            tails = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(t[new], np.arange(n + 1)).astype(np.int32)),
                pa.StructArray.from_arrays([pa.array(c[new].view(np.int64)),
                                            pa.array(np.diff(np.append(new, len(t))).astype(np.int32))], ["code", "f"]))
            sums = [np.bincount(text, x, n) for x in (np.ones(len(text)), seen, log_count[at], neural)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(task + number + np.arange(n)),
                 *[pa.array(x.astype(np.int64)) for x in sums[:2]], *[pa.array(x) for x in sums[2:]], tails],
                ["doc_id", "held_out", "row", "n_tokens", "n_seen", "base", "neural", "tail"])
            number += n
    return run


def score(docs: DataFrame, **how) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    table, counts = gather(docs, **how)
    model = train(docs, counts)
    shared = docs.sparkSession.sparkContext.broadcast((counts, model))
    kind = docs.schema["doc_id"].dataType.simpleString()
    parts = keep_table(docs.select("doc_id", is_held_out().alias("held_out"), text_of().alias("text")).mapInArrow(
        _score(shared), f"doc_id {kind}, held_out boolean, row long, n_tokens long, n_seen long, base double, "
        "neural double, tail array<struct<code:long,f:int>>"), "scored")
    tail = (parts.select("row", F.inline("tail")).join(table, "code")
            .groupBy("row").agg(F.sum("f").alias("n_tail"), F.sum(F.col("f") * F.log10(F.col("c") + 1)).alias("tail_log")))
    both = parts.drop("tail").join(tail, "row", "left").na.fill({"n_tail": 0, "tail_log": 0.0})
    whole = float(np.log10(counts.total + counts.distinct + 1))
    return both.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_seen") + F.col("n_tail")).alias("n_known"),
        F.lit(counts.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("tail_log") - F.col("n_tokens") * whole).alias("base_score"),
        (F.col("neural") + F.col("tail_log")).alias("score"))
