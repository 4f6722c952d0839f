"""Language identification by a linear-chain conditional random field over words.

Every word has a label, its language; words of more than twenty bytes are cut into pieces, each
with a label of its own. Hashed features (the word, prefixes, suffixes, byte
n-grams, membership in a language's lexicon) score the labels of one word, a learned
matrix scores neighbouring labels, and forward-backward gives each word the probability of
every label in its context, so that words within a switch of language are labelled apart
and words without letters follow their neighbours. A document's language is the label with
the largest mean probability over its words with letters; that mean is its score.

Learning takes a bounded sample: per language the ``SAMPLE_ROWS`` different labelled texts
with the smallest hash, found below a bound on the hash that the number of texts sets, so
that hardly more texts than these are shuffled; of each up to ``STRETCHES`` stretches of
``LENGTH`` words anywhere in it. Half of the training sequences are spliced from several languages, from
which the transitions learn to switch. ``SHARDS`` tasks learn on their share of the sample
and their weights are averaged. Texts to be labelled are read whole, once, without shuffle.

Defined cases: NULL texts and texts without a letter are ``und`` with score 0; without
labelled rows every text is ``und``; repeated rows are separate documents; an empty table
gives an empty result; other columns pass through ``keep_identified``, and only the text
is an input of a prediction. Memory grows with the longest document (some 40 bytes a word).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from strata.llm import tokens
from strata.llm.hmm import _longest_first
from strata.operators.ordering import best_per_key
from strata.session import cut_lineage

UNKNOWN = "und"
SAMPLE_ROWS, STRETCHES, LENGTH = 600, 4, 24
SHARDS = 4
BUCKETS = 1 << 16
REACH, PIECE = 20, 16  # a word of more bytes is cut into pieces, which are tokens of their own
LEXICON_LEAST, LEXICON_SHARE = 4, 0.9  # a word enters a lexicon if so often, so surely
EPOCHS, BATCH, RATE, DECAY = 3, 64, 0.3, 1e-5

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SMALL = np.arange(256, dtype=np.uint8)
_SMALL[65:91] += 32
_ASCII_LETTER = np.zeros(256, dtype=bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True
_LETTER = _ASCII_LETTER.copy()
_LETTER[0xC3:] = True  # lead bytes of all letters beyond Latin punctuation
_MARK = np.array([c < 128 and not _ASCII_LETTER[c] for c in range(256)])


def lowered(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z and the capital letters of Latin-1 in lower case."""
    small = _SMALL[data]
    if len(data):
        latin = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)) + 1
        small[latin] += 0x20
    return small


def pieces(found: tokens.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, long ones cut before a character every ``PIECE`` bytes, and
    where each text's begin. Scripts without blanks have sentences as words."""
    size = found.end - found.start
    many = np.where(size > REACH, -(-size // PIECE), 1)
    first = np.concatenate([[0], np.cumsum(many)])
    start = np.repeat(found.start, many) + PIECE * (np.arange(first[-1]) - np.repeat(first[:-1], many))
    inner = np.ones(len(start), dtype=bool)
    inner[first[:-1]] = False
    last = max(len(found.data) - 1, 0)
    for _ in range(3):  # on to the next character
        start += inner & ((found.data[np.minimum(start, last)] & 0xC0) == 0x80)
    end = np.append(start[1:], 0)
    end[first[1:] - 1] = found.end
    full = end > start
    kept = np.concatenate([[0], np.cumsum(full)])
    return start[full], end[full], kept[first[found.at]]


class WordTable:
    """The distinct words of some texts and their feature numbers."""

    def __init__(self, texts: pa.Array):
        found = tokens.words(texts)
        begin, end, self.at = pieces(found)
        data = lowered(found.data)
        for _ in range(3):  # marks around a word
            begin += (end - begin > 1) & _MARK[data[np.minimum(begin, len(data) - 1)]]
            end -= (end - begin > 1) & _MARK[data[end - 1]]
        fingerprint = tokens.fingerprints(data, begin, end)
        self.fingerprint, first, self.which = np.unique(fingerprint, return_index=True, return_inverse=True)
        self.data, self.begin, self.end = data, begin[first], end[first]
        letters = np.cumsum(_LETTER[data], dtype=np.int32)
        self.lettered = letters[self.end - 1] - letters[self.begin] + _LETTER[data[self.begin]] > 0

    def features(self) -> np.ndarray:
        """Feature numbers, a row per distinct word; ``BUCKETS`` means none."""
        n, size = len(self.begin), self.end - self.begin
        column = self.begin[:, None] + np.arange(REACH)
        chars = np.where(np.arange(REACH) < size[:, None], self.data[np.minimum(column, len(self.data) - 1)], 0)
        chars = chars.astype(np.uint64)
        tail = self.end[:, None] - 1 - np.arange(4)
        ends = np.where(np.arange(4) < size[:, None], self.data[np.maximum(tail, 0)], 0).astype(np.uint64)
        parts = [(self.fingerprint, 1, np.ones(n, dtype=bool))]
        for k in range(1, 5):
            shift = np.arange(k, dtype=np.uint64) * np.uint64(8)
            parts.append(((chars[:, :k] << shift).sum(1, dtype=np.uint64), 10 + k, size >= k))
            parts.append(((ends[:, :k] << shift).sum(1, dtype=np.uint64), 20 + k, size >= k))
        for k in (2, 3):
            for i in range(REACH - k + 1):
                gram = sum(chars[:, i + j] << np.uint64(8 * j) for j in range(k))
                parts.append((gram, 30 + k, size >= i + k))
        out = np.empty((n, len(parts)), np.int64)
        for i, (value, kind, there) in enumerate(parts):
            number = tokens.mixed(value ^ tokens.mixed(np.full(1, kind, np.uint64))) % np.uint64(BUCKETS)
            out[:, i] = np.where(there & self.lettered, number.astype(np.int64), BUCKETS)
        return out


class Field:
    """Weights of a conditional random field; ``lexicon`` lists word fingerprints by label."""

    def __init__(self, labels: list[str], lexicon: list[np.ndarray]):
        self.labels, self.lexicon = labels, lexicon
        self.weights = np.zeros((BUCKETS + 1, len(labels)), np.float32)
        self.known = np.zeros((len(labels), len(labels)))  # of membership in each lexicon
        self.moves = np.zeros((len(labels), len(labels)))

    def membership(self, table: WordTable) -> np.ndarray:
        return np.column_stack([np.isin(table.fingerprint, words) for words in self.lexicon]).astype(float)

    def word_scores(self, table: WordTable) -> np.ndarray:
        out = np.zeros((len(table.begin), len(self.labels)))
        for i in range(0, len(out), 20_000):
            part = slice(i, i + 20_000)
            piece = WordTable.__new__(WordTable)
            piece.__dict__.update(
                data=table.data, begin=table.begin[part], end=table.end[part],
                fingerprint=table.fingerprint[part], lettered=table.lettered[part])
            out[part] = self.weights[piece.features()].sum(1)
        return out + self.membership(table) @ self.known

    def label(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text the mean label probabilities over words with letters, their number, and
        how often the most probable label changes."""
        table = WordTable(texts)
        count, k = len(table.at) - 1, len(self.labels)
        share, switches = np.zeros((count, k)), np.zeros(count, np.int64)
        length = np.diff(table.at)
        if len(table.which) == 0:
            return share, np.zeros(count, np.int64), switches
        scores = self.word_scores(table)
        potential = np.exp(scores - scores.max(1, keepdims=True))
        move = np.exp(self.moves - self.moves.max())
        lettered = table.lettered[table.which]
        begin, order, active = _longest_first(table.at[:-1], length)
        forward = np.empty((len(table.which), k), np.float32)
        state = None
        for t, n in enumerate(active):
            where = begin[:n] + t
            state = potential[table.which[where]] * (1 if t == 0 else state[:n] @ move)
            state = state / state.sum(1, keepdims=True)
            forward[where] = state
        best = np.empty(len(table.which), np.int16)
        total = np.zeros((count, k))
        back = np.ones((0, k))
        for t in range(len(active) - 1, -1, -1):
            n = active[t]
            where = begin[:n] + t
            whole = np.ones((n, k))
            whole[: len(back)] = back
            likely = forward[where] * whole
            likely /= likely.sum(1, keepdims=True)
            total[:n] += likely * lettered[where][:, None]
            best[where] = likely.argmax(1)
            back = (potential[table.which[where]] * whole) @ move.T
            back /= back.sum(1, keepdims=True)
        letters = np.diff(np.concatenate([[0], np.cumsum(lettered)])[table.at])
        share[order] = total
        share /= np.maximum(letters, 1)[:, None]
        changed = np.concatenate([[0], np.cumsum(best[1:] != best[:-1]), [0]])
        full = length > 0
        switches[full] = changed[table.at[1:][full] - 1] - changed[table.at[:-1][full]]
        return share, letters, switches


def _sequences(table: WordTable, labels: np.ndarray, rng) -> tuple[np.ndarray, np.ndarray]:
    """Training sequences of ``LENGTH`` words, half of them spliced, with their labels."""
    sizes = np.diff(table.at)
    usable = np.flatnonzero(sizes > 0)
    words = np.zeros((len(usable), LENGTH), np.int64)
    marks = np.zeros((len(usable), LENGTH), np.int64)
    for row in range(len(usable)):
        mixed, filled, source = row % 2, 0, usable[row]
        while filled < LENGTH:
            take = min(LENGTH - filled, sizes[source], rng.integers(3, LENGTH) if mixed else LENGTH)
            piece = table.which[table.at[source]: table.at[source] + take]
            words[row, filled: filled + take], marks[row, filled: filled + take] = piece, labels[source]
            filled += take
            same = usable[labels[usable] == labels[source]]
            source = rng.choice(usable if mixed else same)
    return words, marks


def _gradient(scores: np.ndarray, moves: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Observed minus expected labels of every word, and of every pair of neighbours."""
    rows, length, k = scores.shape
    potential = np.exp(scores - scores.max(2, keepdims=True))
    move = np.exp(moves - moves.max())
    forward, back = np.empty_like(scores), np.ones_like(scores)
    for t in range(length):
        state = potential[:, t] * (1 if t == 0 else forward[:, t - 1] @ move)
        forward[:, t] = state / state.sum(1, keepdims=True)
    pairs = np.zeros((k, k))
    for t in range(length - 1, 0, -1):
        ahead = potential[:, t] * back[:, t]
        joint = forward[:, t - 1, :, None] * move * ahead[:, None, :]
        pairs -= (joint / joint.sum((1, 2), keepdims=True)).sum(0)
        state = ahead @ move.T
        back[:, t - 1] = state / state.sum(1, keepdims=True)
    likely = forward * back
    likely /= likely.sum(2, keepdims=True)
    observed = np.eye(k)[marks]
    np.add.at(pairs, (marks[:, :-1].ravel(), marks[:, 1:].ravel()), 1)
    return observed - likely, pairs


def learn(field: Field, texts: pa.Array, labels: np.ndarray, seed: int) -> Field:
    """AdaGrad on the likelihood of spliced sequences."""
    rng = np.random.default_rng(seed)
    table = WordTable(texts)
    features, member = table.features(), field.membership(table)
    k = len(field.labels)
    slope = [np.full(w.shape, 1e-2) for w in (field.weights, field.known, field.moves)]
    for _ in range(EPOCHS):
        words, marks = _sequences(table, labels, rng)
        shuffled = rng.permutation(len(words))
        for i in range(0, len(words), BATCH):
            rows = shuffled[i: i + BATCH]
            used, inside = np.unique(words[rows], return_inverse=True)
            inside = inside.reshape(len(rows), LENGTH)
            own = features[used]
            scores = field.weights[own].sum(1) + member[used] @ field.known
            change, pairs = _gradient(scores[inside], field.moves, marks[rows])
            per_word = np.zeros((len(used), k))
            np.add.at(per_word, inside.ravel(), change.reshape(-1, k))
            touched, place = np.unique(own, return_inverse=True)
            grad = np.zeros((len(touched), k))
            np.add.at(grad, place.ravel(), np.repeat(per_word, own.shape[1], 0))
            real = touched < BUCKETS  # the last row stays zero
            touched, grad = touched[real], grad[real] / len(rows) - DECAY * field.weights[touched[real]]
            steps = ((field.weights, touched, grad), (field.known, slice(None), member[used].T @ per_word / len(rows)),
                     (field.moves, slice(None), pairs / len(rows)))
            for (weights, at, g), total in zip(steps, slope):
                total[at] += g * g
                weights[at] += RATE * g / np.sqrt(total[at])
    return field


def _stretches(rows: DataFrame) -> DataFrame:
    """Written ``label, text``: stretches of words of the sampled rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, texts = [], []
            for label, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist()):
                words = _WORD.findall(text)
                rng = np.random.default_rng(len(words))
                for at in sorted(rng.integers(0, max(1, len(words) - LENGTH + 1), STRETCHES if len(words) > LENGTH else 1)):
                    labels.append(label)
                    texts.append(" ".join(words[at: at + LENGTH]))
            yield pa.RecordBatch.from_arrays([pa.array(labels, pa.string()), pa.array(texts, pa.string())], ["label", "text"])

    return cut_lineage(rows.mapInArrow(run, "label string, text string"), "stretches")


def sampled(rows: DataFrame, number: int = SAMPLE_ROWS) -> DataFrame:
    """Per label the ``number`` different texts with the smallest hash: ``label, text``."""
    hashed = rows.withColumn("hash", F.xxhash64("text"))
    counts = hashed.groupBy("label").agg(F.approx_count_distinct("hash").alias("texts"))
    # Four times as many are expected below the bound; with few texts it lets all pass.
    share = F.least(F.lit(1.0), F.lit(4.0 * number) / F.col("texts"))
    bounds = {r["label"]: r["share"] for r in counts.select("label", share.alias("share")).collect()}  # a row per label
    bound = F.lit(0.0)
    for label, value in bounds.items():
        bound = F.when(F.col("label") == label, F.lit(value)).otherwise(bound)
    few = hashed.filter(F.pmod("hash", F.lit(1 << 30)) <= bound * (1 << 30)).dropDuplicates(["label", "hash"])
    return best_per_key(few, ["label"], [F.pmod("hash", F.lit(1 << 30)), F.col("hash")], number).select("label", "text")


def fitted(labelled: DataFrame) -> Field:
    """A field learned from a sample of ``text, label``; rows without either are left out."""
    rows = labelled.select(F.col("label").cast("string").alias("label"), F.col("text").cast("string").alias("text"))
    rows = rows.filter(F.col("label").isNotNull() & F.col("text").rlike(r"\S"))
    sample = _stretches(sampled(rows))
    labels = sorted(r["label"] for r in sample.select("label").distinct().collect())

    # The lexicon: words of the sample that nearly always stand in one language.
    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = WordTable(batch.column("text"))
            label = batch.column("label").take(pa.array(np.repeat(np.arange(batch.num_rows), np.diff(table.at))))
            word = pa.array(table.fingerprint[table.which].view(np.int64))
            real = pa.array(table.lettered[table.which])
            yield pa.RecordBatch.from_arrays([label, word], ["label", "word"]).filter(real)

    counts = sample.mapInArrow(words, "label string, word long").groupBy("word").agg(
        F.count(F.lit(1)).alias("n"), F.mode("label", True).alias("label"),
        *[F.count_if(F.col("label") == label).alias(f"n{i}") for i, label in enumerate(labels)])
    top = F.greatest(*[F.col(f"n{i}") for i in range(len(labels))], F.lit(0)) if labels else F.lit(0)
    sure = counts.filter((F.col("n") >= LEXICON_LEAST) & (top >= LEXICON_SHARE * F.col("n"))).select("label", "word").collect()
    lexicon = [np.sort(np.array([r["word"] for r in sure if r["label"] == label], np.int64).view(np.uint64)) for label in labels]
    if not labels:
        return Field([], [])
    number = {label: i for i, label in enumerate(labels)}

    def train(table: pa.Table) -> pa.Table:
        table = table.sort_by([("label", "ascending"), ("text", "ascending")])
        texts = table["text"].combine_chunks()
        marks = np.array([number[x] for x in table["label"].to_pylist()])
        field = learn(Field(labels, lexicon), texts, marks, int(table["shard"][0].as_py()))
        parts = (field.weights, field.known.astype(np.float32), field.moves.astype(np.float32))
        return pa.table({"weights": pa.array([b"".join(p.tobytes() for p in parts)], pa.binary())})

    shard = F.pmod(F.xxhash64("text", "label"), F.lit(SHARDS)).alias("shard")
    found = sample.select(shard, "label", "text").groupBy("shard").applyInArrow(train, "weights binary").collect()
    field, k = Field(labels, lexicon), len(labels)
    mean = np.mean([np.frombuffer(r["weights"], np.float32) for r in sorted(found)], axis=0)
    field.weights, rest = mean[: (BUCKETS + 1) * k].reshape(-1, k), mean[(BUCKETS + 1) * k:]
    field.known, field.moves = rest[: k * k].reshape(k, k).astype(float), rest[k * k:].reshape(k, k).astype(float)
    return field


def _verdicts(field: Field, texts: pa.Array) -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
    count = len(texts)
    if not field.labels:
        return [UNKNOWN] * count, np.zeros(count), np.zeros(count, np.int64), np.zeros(count, np.int64)
    share, letters, switches = field.label(texts)
    best = share.argmax(1)
    score = share[np.arange(count), best]
    names = [field.labels[b] for b in best]
    data, offsets = tokens.buffers(texts)
    plain = np.add.reduceat(np.append(_ASCII_LETTER[data], False), offsets[:-1], dtype=np.int64) * (np.diff(offsets) > 0)
    for d in np.flatnonzero((plain == 0) | (letters == 0)):
        text = texts[d].as_py()
        if letters[d] == 0 or not any(c.isalpha() for c in text or ""):
            if any(c.isalpha() for c in text or ""):  # letters this module's byte test does not see
                score[d] = 1 / len(field.labels)
            else:
                names[d], score[d] = UNKNOWN, 0.0
    return names, np.clip(score, 0, 1), letters, switches


VERDICT = ("lang_pred", "score", "n_words", "n_switches")


def identified(docs: DataFrame, field: Field) -> DataFrame:
    """``docs`` (with ``text``) without the text, and the columns of ``VERDICT``, which replace others of the name."""
    model = docs.sparkSession.sparkContext.broadcast(field)  # buckets times labels, a few megabytes
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in ("text", *VERDICT)])
    packed = docs.select(others.alias("row"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tokens.slices(batch):
                names, score, letters, switches = _verdicts(model.value, part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), pa.array(names, pa.string()), pa.array(score),
                     pa.array(letters, pa.int64()), pa.array(switches, pa.int64())], ["row", *VERDICT])

    schema = StructType([packed.schema["row"], StructField("lang_pred", StringType()), StructField("score", DoubleType()),
                         StructField("n_words", LongType()), StructField("n_switches", LongType())])
    return packed.mapInArrow(run, schema).select("row.*", *VERDICT)


def keep_identified(docs: DataFrame, field: Field, least: float = 0.35) -> DataFrame:
    """The rows of ``docs`` with a language of at least that score, unchanged."""
    model = docs.sparkSession.sparkContext.broadcast(field)

    def sure(part: pa.RecordBatch) -> np.ndarray:
        names, score, _, _ = _verdicts(model.value, part.column("text"))
        return np.array([n != UNKNOWN for n in names], dtype=bool) & (score >= least)

    return tokens.filtered(docs, sure)
