"""A hidden Markov language model and its exact likelihood of every text.

Tokens are words and one end mark per text. The hidden states emit one of 256 word
classes: each of the most frequent words is a class of its own, all other words share
classes by their ending. Given its class, a word has its add-one share of the class's
training tokens, with room for one unknown word. So a text's probability is that of its
class sequence, which the scaled forward recursion sums over all state paths, times the
words' shares.

* Counting: every task adds up its words, one shuffle adds up the tasks. The vocabulary
  stays a table.
* Baum-Welch: every pass runs forward-backward over all training texts, whole; a task
  emits one row of expected counts and Spark adds the rows up. Within a task, texts are
  worked on in stretches of ``STRETCH`` tokens side by side: the matrix of each stretch
  carries the forward vector to the next one and the backward vector back, so counts and
  likelihood are those of uncut texts, and a text of millions of tokens takes no longer
  than as many short ones.
* Scoring: up to ``FREQUENT`` most frequent words (two megabytes) travel to the tasks; all
  other words of a document, each once with its number, meet the vocabulary in a join.

Defined cases: a NULL or empty text is its end mark alone; a NULL id hashes as the empty
text; repeated rows count as separate documents in training and result; without training
rows every token has the same base probability 1 and the model's start values score; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import tokens
from strata.session import cut_lineage

STATES = 8
CLASSES = 256
OWN = 191  # classes of one frequent word each; then the endings; the last is the end mark
ENDINGS = CLASSES - OWN - 1
END_CLASS = CLASSES - 1
END_KEY = np.uint64(0x5E7D)
FREQUENT = 1 << 17
STRETCH = 2048
PASSES = 5
PSEUDO = 0.01
TOKENS_AT_ONCE = 400_000


def remainder(doc_id: Column, divisor: int) -> Column:
    """CRC-32 of the id as text, modulo ``divisor``."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(divisor))


def _ending(found: tokens.Words) -> np.ndarray:
    """Class of each word by its last two bytes, letters A-Z lower-cased."""
    small = np.arange(256, dtype=np.uint64)
    small[65:91] += np.uint64(32)
    last = small[found.data[found.end - 1]]
    before = np.where(found.end - found.start > 1, small[found.data[np.maximum(found.end - 2, 0)]], np.uint64(0))
    return (OWN + tokens.mixed(last * np.uint64(256) + before) % np.uint64(ENDINGS)).astype(np.uint8)


def _shape(batch: pa.RecordBatch):
    found = tokens.words(batch.column("text"))
    return found, found.fingerprints(lower=True), _ending(found)


def vocabulary(training: DataFrame) -> DataFrame:
    """``word, ending, n``: how often each token occurs in the training texts; written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tokens.slices(batch):
                _, h, ending = _shape(part)
                word, first, n = np.unique(h, return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.append(word, END_KEY).view(np.int64)),
                     pa.array(np.append(ending[first], END_CLASS).astype(np.int32)),
                     pa.array(np.append(n, part.num_rows))], ["word", "ending", "n"])

    counted = training.select("text").mapInArrow(run, "word long, ending int, n long")
    return cut_lineage(counted.groupBy("word", "ending").agg(F.sum("n").alias("n")), "vocabulary")


class Lexicon:
    """What tasks need of the vocabulary: frequent words, totals of the classes, N and V."""

    def __init__(self, words: DataFrame):
        # Words above a number of occurrences that at most FREQUENT words reach, in steps of 4%.
        step = F.floor(F.log2("n") * 16).cast("int")
        steps = sorted(words.groupBy(step.alias("step")).count().collect(), key=lambda r: -r["step"])
        reached = np.cumsum([r["count"] for r in steps])
        least = [r["step"] for r, c in zip(steps, reached) if c <= FREQUENT]
        top = words.filter(step >= least[-1]) if least else words.limit(0)
        top = top.toArrow().sort_by([("n", "descending"), ("word", "ascending")])
        key, n, ending = (top[c].to_numpy() for c in ("word", "n", "ending"))
        key = key.view(np.uint64)
        plain = np.flatnonzero(key != END_KEY)[:OWN]
        own = np.full(len(key), -1)
        own[plain] = np.arange(len(plain))
        order = np.argsort(key)
        self.key, self.n, self.own = key[order], n[order], own[order]
        self.total, self.distinct = 0, 0
        self.class_room = np.ones(CLASSES)  # N + V + 1 of each class
        for r in words.groupBy("ending").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect():
            self.total += r["n"]
            self.distinct += r["v"]
            self.class_room[r["ending"]] += r["n"] + r["v"]
        for i in plain:
            self.class_room[ending[i]] -= n[i] + 1
        self.end_n = words.filter(F.col("ending") == END_CLASS).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    def known(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place among the frequent words, and whether there is one."""
        if len(self.key) == 0:
            return np.zeros(len(h), np.int64), np.zeros(len(h), dtype=bool)
        at = np.minimum(np.searchsorted(self.key, h), len(self.key) - 1)
        return at, self.key[at] == h


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0.0], np.cumsum(values)])[at])


def read_tokens(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Written rows per document: class sequence, sums over frequent words, and the other words.

    ``classes`` holds a byte per token; ``log_frequent`` and ``log_shared`` are sums of
    ``log10(n + 1)`` over frequent words, all and those in shared classes; ``log_room`` is
    the sum over all words in shared classes of the class's ``log10(N + V + 1)``.
    """
    model = docs.sparkSession.sparkContext.broadcast(lexicon)
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = model.value
        for batch in batches:
            for part in tokens.slices(batch):
                found, h, classes = _shape(part)
                place, frequent = lex.known(h)
                own = np.where(frequent, lex.own[place] if len(lex.own) else -1, -1)
                classes = np.where(own >= 0, own, classes).astype(np.uint8)
                logs = np.where(frequent, np.log10((lex.n[place] if len(lex.n) else 0) + 1.0), 0.0)
                shared = own < 0
                rare = np.flatnonzero(~frequent)
                doc = np.repeat(np.arange(part.num_rows), found.counts)[rare]
                order = np.lexsort((h[rare], doc))
                doc, word = doc[order], h[rare][order]
                new = np.ones(len(word), dtype=bool)
                new[1:] = (word[1:] != word[:-1]) | (doc[1:] != doc[:-1])
                first = np.flatnonzero(new)
                times = np.diff(np.append(first, len(word)))
                offsets = pa.array(np.searchsorted(doc[first], np.arange(part.num_rows + 1)).astype(np.int32))
                with_end = np.insert(classes, found.at[1:], END_CLASS)
                ends = (found.at + np.arange(len(found.at))).astype(np.int64)
                sequence = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), part.num_rows, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(with_end.tobytes())])
                yield pa.RecordBatch.from_arrays([
                    part.column("row"), part.column("doc_id"), part.column("held_out"), sequence.cast(pa.binary()),
                    pa.array(_sums(logs, found.at)), pa.array(_sums(logs * shared, found.at)),
                    pa.array(_sums(np.log10(lex.class_room)[classes] * shared, found.at)),
                    pa.array(_sums(frequent.astype(float), found.at).round().astype(np.int64)),
                    pa.ListArray.from_arrays(offsets, pa.array(word[first].view(np.int64))),
                    pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int64))),
                ], ["row", "doc_id", "held_out", "classes", "log_frequent", "log_shared", "log_room", "n_frequent",
                    "words", "times"])

    schema = ("row long, doc_id long, held_out boolean, classes binary, log_frequent double, log_shared double, "
              "log_room double, n_frequent long, words array<long>, times array<long>")
    return cut_lineage(numbered.mapInArrow(run, schema), "tokens")


class Model:
    """Start, transition and emission probabilities."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.start = np.full(STATES, 1 / STATES)
        self.move = 0.5 * np.eye(STATES) + 0.5 * rng.dirichlet(np.full(STATES, 5.0), STATES)
        self.emit = rng.dirichlet(np.full(CLASSES, 5.0), STATES)

    SIZES = (STATES, STATES * STATES, STATES * CLASSES, 1)  # of the expected counts

    @staticmethod
    def updated(counts: np.ndarray) -> "Model":
        start, move, emit, _ = np.split(counts, np.cumsum(Model.SIZES)[:-1])
        new = Model.__new__(Model)
        new.start = (start + PSEUDO) / (start + PSEUDO).sum()
        move, emit = move.reshape(STATES, STATES) + PSEUDO, emit.reshape(STATES, CLASSES) + PSEUDO
        new.move, new.emit = move / move.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True)
        return new


def sequences(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_binary())
    _, where, raw = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset: column.offset + len(column) + 1]
    return np.frombuffer(raw, np.uint8)[offsets[0]: offsets[-1]], offsets - offsets[0]


def _longest_first(begin: np.ndarray, length: np.ndarray):
    """Rows by descending length, and for every step how many are that long."""
    order = np.argsort(-length, kind="stable")
    if len(length) == 0:
        return begin, order, order
    active = len(length) - np.searchsorted(np.sort(length), np.arange(1, length.max() + 1), "left")
    return begin[order], order, active


class Stretches:
    """Consecutive texts cut into stretches of ``STRETCH`` tokens, and what passes between these.

    ``begin`` and ``length`` place a stretch in ``data``, ``first`` and ``last`` mark those that
    begin or end a text. Going through a stretch multiplies the state vector by a matrix, so the
    matrices of all stretches are found side by side, and the vectors of a long text then pass
    from stretch to stretch: no step follows a text token by token, and none is left out.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, length = data, np.diff(offsets)
        self.pieces = -(-length // STRETCH)
        self.at = np.cumsum(self.pieces) - self.pieces  # a text's first stretch
        text = np.repeat(np.arange(len(length)), self.pieces)
        self.number = np.arange(len(text)) - self.at[text]
        self.begin = offsets[:-1][text] + self.number * STRETCH
        self.length = np.minimum(STRETCH, offsets[1:][text] - self.begin)
        self.first, self.last = self.number == 0, self.number == self.pieces[text] - 1

    def through(self, model: Model, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per stretch the matrix from the vector before its first token to that at its last,
        its entries adding up to one, and the logarithm of the factor taken out."""
        begin, order, active = _longest_first(self.begin[which], self.length[which])
        emit = np.ascontiguousarray(model.emit.T)
        matrix = np.repeat(np.eye(STATES)[None], len(begin), axis=0)
        logs = np.zeros(len(begin))
        for t, n in enumerate(active):
            step = matrix[:n] if t == 0 else (matrix[:n].reshape(-1, STATES) @ model.move).reshape(n, STATES, STATES)
            step = step * emit[self.data[begin[:n] + t]][:, None, :]
            scale = step.sum((1, 2))
            matrix[:n] = step / scale[:, None, None]
            logs[:n] += np.log(scale)
        back = np.argsort(order, kind="stable")
        return matrix[back], logs[back]

    def carried(self, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per stretch the state vector before it (that at the last token of the one before, or
        zero), the vector expected at its first token, and the backward vector at its last;
        per text the log likelihood of all its stretches but the last."""
        n = len(self.begin)
        before, prior, after = np.zeros((n, STATES)), np.tile(model.start, (n, 1)), np.ones((n, STATES))
        passed = np.zeros(len(self.pieces))
        inner = np.flatnonzero(~(self.first & self.last))
        if len(inner) == 0:
            return before, prior, after, passed
        place = np.zeros(n, np.int64)
        place[inner] = np.arange(len(inner))
        matrix, logs = self.through(model, inner)
        long = np.flatnonzero(self.pieces > 1)
        long = long[np.argsort(-self.pieces[long], kind="stable")]
        count = self.pieces[long]
        for j in range(count[0] - 1):  # forward, all long texts at once
            texts = long[: np.searchsorted(-count, -(j + 1), "left")]
            here = self.at[texts] + j
            state = np.einsum("ni,nij->nj", prior[here], matrix[place[here]])
            scale = state.sum(1)
            passed[texts] += np.log(scale) + logs[place[here]]
            before[here + 1] = state / scale[:, None]
            prior[here + 1] = before[here + 1] @ model.move
        for j in range(count[0] - 1, 0, -1):  # backward
            texts = long[: np.searchsorted(-count, -j, "left")]
            here = self.at[texts] + j
            value = np.einsum("nij,nj->ni", matrix[place[here]], after[here]) @ model.move.T
            after[here - 1] = value / value.sum(1, keepdims=True)
        return before, prior, after, passed


def log_likelihood(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """log10 probability of every sequence by the scaled forward recursion."""
    out = np.zeros(len(offsets) - 1)
    cut = Stretches(data, offsets)
    if len(cut.begin) == 0:
        return out
    _, prior, _, out = cut.carried(model)
    last = np.flatnonzero(cut.last)
    begin, order, active = _longest_first(cut.begin[last], cut.length[last])
    prior, emit = prior[last][order], np.ascontiguousarray(model.emit.T)
    total = np.zeros(len(last))
    state = None
    for t, n in enumerate(active):
        state = (prior if t == 0 else state[:n] @ model.move) * emit[data[begin[:n] + t]]
        scale = state.sum(1)
        state = state / scale[:, None]
        total[:n] += np.log(scale)
    out[np.flatnonzero(cut.pieces)[order]] += total
    return out / math.log(10)


def expected_counts(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Baum-Welch counts of whole texts, and their log likelihood."""
    cut = Stretches(data, offsets)
    before, prior, after, passed = cut.carried(model)
    total = np.zeros(sum(Model.SIZES))
    total[-1] = passed.sum()
    # Stretches of like length together, so that few steps serve few rows.
    by_length = np.argsort(cut.length, kind="stable")
    group = np.cumsum(cut.length[by_length]) // TOKENS_AT_ONCE
    for some in np.split(by_length, np.flatnonzero(np.diff(group)) + 1):
        if len(some):
            total += _inside(model, data, cut.begin[some], cut.length[some], cut.first[some], cut.last[some],
                             before[some], prior[some], after[some])
    return total


def _inside(model: Model, data: np.ndarray, begin: np.ndarray, length: np.ndarray, first: np.ndarray,
            last: np.ndarray, before: np.ndarray, prior: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Counts of some stretches, transitions into their first tokens included."""
    begin, order, active = _longest_first(begin, length)
    first, last, before, prior, after = first[order], last[order], before[order], prior[order], after[order]
    emit = np.ascontiguousarray(model.emit.T)
    forward, scales, seen = [], [], []
    for t, n in enumerate(active):
        e = emit[data[begin[:n] + t]]
        state = (prior if t == 0 else forward[-1][:n] @ model.move) * e
        scale = state.sum(1)
        forward.append(state / scale[:, None])
        scales.append(scale)
        seen.append(e)
    start, move, emitted = np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((STATES, CLASSES))
    back, likelihood = np.ones((0, STATES)), 0.0
    for t in range(len(active) - 1, -1, -1):
        n, m = active[t], len(back)
        whole = after[:n].copy()
        # Where a stretch ends, forward and backward vector together are one.
        whole[m:] /= (forward[t][m:] * whole[m:]).sum(1, keepdims=True)
        if m:
            later = back * seen[t + 1] / scales[t + 1][:, None]
            whole[:m] = later @ model.move.T
            move += forward[t][:m].T @ later
        back = whole
        share = forward[t] * back
        what = data[begin[:n] + t]
        for k in range(STATES):
            emitted[k] += np.bincount(what, share[:, k], CLASSES)
        likelihood += np.log(scales[t][last[:n]]).sum()
    if len(back):
        start = (forward[0] * back)[first].sum(0)
        move += before.T @ (back * seen[0] / scales[0][:, None])  # zero before a text
    return np.concatenate([start, (move * model.move).ravel(), emitted.ravel(), [likelihood]])


def trained(rows: DataFrame, passes: int = PASSES) -> Model:
    """Baum-Welch over the class sequences ``classes`` of all rows."""
    model = Model()
    spark = rows.sparkSession

    def one_pass(current: Model) -> np.ndarray:
        shared = spark.sparkContext.broadcast(current)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, any_row = np.zeros(sum(Model.SIZES)), False
            for batch in batches:
                data, offsets = sequences(batch.column("classes"))
                if len(data):
                    total += expected_counts(shared.value, data, offsets)
                    any_row = True
            if any_row:
                yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["counts"])

        counts = rows.select("classes").mapInArrow(run, "counts array<double>")
        summed = counts.select(F.posexplode("counts")).groupBy("pos").agg(F.sum("col").alias("n")).collect()
        total = np.zeros(sum(Model.SIZES))  # a row per parameter
        for r in summed:
            total[r["pos"]] = r["n"]
        return total

    for _ in range(passes):
        counts = one_pass(model)
        if not counts.any():
            break
        model = Model.updated(counts)
    return model


def scored(docs: DataFrame, passes: int = PASSES) -> DataFrame:
    """Scores of all rows of ``docs`` (``doc_id, text, held_out``), learned from those not held out.

    Returns ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), "held_out")
    words = vocabulary(plain.filter(~F.col("held_out")))
    lexicon = Lexicon(words)
    rows = read_tokens(plain, lexicon)
    model = rows.sparkSession.sparkContext.broadcast(trained(rows.filter(~F.col("held_out")), passes))

    kept = ["row", "doc_id", "held_out", "log_frequent", "log_shared", "log_room", "n_frequent"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = sequences(batch.column("classes"))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(log_likelihood(model.value, data, offsets)),
                 pa.array(np.diff(offsets))], [*kept, "path_score", "n_tokens"])

    paths = rows.select(*kept, "classes").mapInArrow(
        run, "row long, doc_id long, held_out boolean, log_frequent double, log_shared double, log_room double, "
             "n_frequent long, path_score double, n_tokens long")
    rare = rows.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select(
        "row", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
    found = rare.join(words.select("word", "n"), "word").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("log_rare"), F.sum("times").alias("n_rare"))
    joined = paths.join(found, "row", "left")
    room = math.log10(lexicon.total + lexicon.distinct + 1)
    end = math.log10(lexicon.end_n + 1)
    rare_log, rare_n = F.coalesce("log_rare", F.lit(0.0)), F.coalesce("n_rare", F.lit(0))
    return joined.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_frequent") + rare_n + F.lit(int(lexicon.end_n > 0))).cast("long").alias("n_known"),
        F.lit(lexicon.total).cast("long").alias("train_tokens"),
        (F.col("log_frequent") + rare_log + F.lit(end) - F.col("n_tokens") * F.lit(room)).alias("base_score"),
        (F.col("path_score") + F.col("log_shared") + rare_log - F.col("log_room")).alias("score"))
