"""Alignment of the tokens of two tokenizers over the same texts.

Tokenizer A is a byte-level vocabulary, B one of pieces with byte fallback; both see a space
and then the text. Their tokens are byte ranges, so two tokens are linked where their ranges
overlap, and offsets at which tokens of both end cut them into groups.

Both lists of token ends ascend, and merging them gives links and groups. The merge is cut
along diagonals: a binary search finds for every ``WORK``-th step of the merge how many ends
of A and of B come before it, so pieces have equal work however long a document or a token
is, and need nothing from each other. A piece emits the links of its own ends and the ends
that both sides share inside it; where an end of A closes a piece and the same end of B opens
the next one, the two are stitched: the group closes there and the second piece's first link
goes. One task tokenises a document and merges its pieces one after the other.

``linked`` makes one pass over the texts. Links are counted over the corpus by pair of ids;
the most frequent pairs, at most ``FREQUENT`` of them, are sent to all tasks to look their
counts up, all other pairs of a document are joined with the counts. Texts beyond
``CUT_CHARS`` are tokenised in parts, cut at a single blank between two ASCII letters, where
no token of either vocabulary can cross.

Defined cases: NULL and empty texts, and texts whose joined token bytes differ from those of
a space and the text, have no tokens and count nothing; strings of special tokens are plain
text; repeated rows count each; a NULL id is an id like any other; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import cache
from itertools import chain, compress, groupby, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import tokens
from strata.session import cut_lineage

FOLDER = "/opt/tokenizers"  # on every machine; a parameter
BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
WORK = 1 << 15  # ends merged by one piece
TEXT_BYTES = 1 << 20  # of documents tokenised together
CUT_CHARS = 1 << 18
KEPT_CHARS = 1 << 22  # of words whose tokens are kept
RUN_CHARS = 1 << 12  # of new words tokenised as one text
FREQUENT = 1 << 17  # pairs looked up without a join
PAIR_BITS = 16  # of the B id in a pair's number
CUT = re.compile("(?<=[A-Za-z]) (?=[A-Za-z])")
BLANK = "▁"
WORD_CUT = re.compile(f"(?<=[^\\s\u180e{BLANK}]) (?=[^\\s\u180e{BLANK}])")  # U+180E was white space once
PLAIN = re.compile(f"[^\\s\u180e{BLANK}]([^{BLANK}]*[^\\s\u180e{BLANK}])?")  # may stand between two such blanks


def _byte_characters() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for
    themselves, the others in order from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _texts(ids: int, inside: str, closing: str) -> np.ndarray:
    """At ``2 * id + closes`` the bytes of an id with what follows it."""
    out = np.empty(2 * ids, object)
    out[0::2] = [f"{i}{inside}".encode() for i in range(ids)]
    out[1::2] = [f"{i}{closing}".encode() for i in range(ids)]
    return out


def _starts(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])


class Tokenizers:
    """Both vocabularies with the bytes of every id."""

    def __init__(self, folder: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks use the cores
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(os.path.join(folder, BYTE_LEVEL))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=os.path.join(folder, PIECES))
        known, table = self.a.get_vocab(with_added_tokens=True), _byte_characters()
        self.a_bytes = [b""] * (max(known.values()) + 1)
        for token, i in known.items():
            self.a_bytes[i] = bytes(table[c] for c in token)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)]
        self.cuttable = all(BLANK not in p.lstrip(BLANK) for p in pieces)
        self.a_length = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_length = np.array([len(x) for x in self.b_bytes], np.int64)
        self.a_text = _texts(len(self.a_bytes), ",", "|")
        self.b_text = _texts(len(self.b_bytes), ",", ";")
        self.forget()

    def forget(self) -> None:
        """Keep no word's tokens."""
        self.number = defaultdict()  # of every word kept
        self.number.default_factory = self.number.__len__
        self.kept_chars = 0
        # Ids of A and B, where each word's begin, and how many they are.
        self.kept = [(np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64))] * 2
        self.same = np.zeros(0, dtype=bool)  # whether the tokens of both give a word back

    def together(self, words: list[str]) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """Per side the ids of words that neither begin nor end with white space, tokenised in
        runs, and how many each word has; None where a run does not come back from them."""
        run = np.cumsum([len(w) for w in words]) // RUN_CHARS
        runs = [" ".join(words[k] for k in some) for _, some in groupby(range(len(words)), run.__getitem__)]
        spaced = [" " + r for r in runs]
        whole, ends = "".join(spaced).encode(), np.cumsum([len(w.encode()) + 1 for w in words])
        out = []
        for found, known, length in (
                ([e.ids for e in self.a.encode_batch_fast(spaced, add_special_tokens=False)], self.a_bytes, self.a_length),
                (self.b.encode(runs, num_threads=1), self.b_bytes, self.b_length)):
            ids = np.fromiter(chain.from_iterable(found), np.int32, sum(map(len, found)))
            stops = np.cumsum(length[ids])
            if not length[ids].all() or b"".join(map(known.__getitem__, ids.tolist())) != whole:
                return None
            last = np.searchsorted(stops, ends)
            if (stops[last] != ends).any():
                return None
            out.append((ids, np.diff(last, prepend=-1)))
        return out

    def learn(self, words: list[str]) -> None:
        """Keep the tokens of words that have just been numbered."""
        plain = np.array([self.cuttable and PLAIN.fullmatch(w) is not None for w in words], dtype=bool)
        runs = self.together([*compress(words, plain)]) if plain.any() else None
        if runs is None:
            plain[:] = False
            runs = [(np.zeros(0, np.int32), np.zeros(0, np.int64))] * 2
        single = [*compress(words, ~plain)]
        spaced = [" " + w for w in single]
        sides = ([], []) if not single else (
            [e.ids for e in self.a.encode_batch_fast(spaced, add_special_tokens=False)], self.b.encode(single, num_threads=1))
        same, order = np.ones(len(words), dtype=bool), np.argsort(~plain, kind="stable")
        for side, (found, known) in enumerate(zip(sides, (self.a_bytes, self.b_bytes))):
            same[~plain] &= np.array(
                [b"".join(map(known.__getitem__, own)) == w.encode() for own, w in zip(found, spaced)], dtype=bool)
            own = np.fromiter(chain.from_iterable(found), np.int32, sum(map(len, found)))
            counts = np.concatenate([runs[side][1], np.fromiter(map(len, found), np.int64, len(found))])
            ids, begin, many = self.kept[side]
            its_begin, its_many = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
            its_begin[order], its_many[order] = len(ids) + _starts(counts)[:-1], counts
            self.kept[side] = tuple(map(np.concatenate, (
                (ids, runs[side][0], own), (begin, its_begin), (many, its_many))))
        self.kept_chars += sum(map(len, words))
        self.same = np.concatenate([self.same, same])

    def tokenised(self, parts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
        """Ids of A and B for every part, and whether all its words come back from them."""
        if self.kept_chars > KEPT_CHARS or len(self.same) < len(self.number):  # the latter after an error
            self.forget()
        words = [WORD_CUT.split(p) if self.cuttable else [p] for p in parts]
        at = _starts([len(w) for w in words])
        number = np.fromiter(map(self.number.__getitem__, chain.from_iterable(words)), np.int64, at[-1])
        if new := len(self.number) - len(self.same):
            self.learn([*islice(reversed(self.number), new)][::-1])
        sides = []
        for ids, begin, many in self.kept:
            to = _starts(many[number])
            place = np.arange(to[-1]) + np.repeat(begin[number] - to[:-1], many[number])
            sides.append(np.split(ids[place].astype(np.int64), to[at[1:-1]]))
        return sides, np.diff(_starts(~self.same[number])[at]) == 0

    def parts(self, text: str) -> list[str]:
        """A long text cut at blanks that both vocabularies begin a token with."""
        out, start = [], 0
        while self.cuttable and len(text) - start > CUT_CHARS:
            found = CUT.search(text, start + CUT_CHARS)
            if found is None:
                break
            out.append(text[start: found.start()])
            start = found.end()
        return [*out, text[start:]]

    def encoded(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of A and B for every text, none where they do not give the text back."""
        out = []
        cut = [self.parts(t) if t else [] for t in texts]
        flat = [p for parts in cut for p in parts]
        sides, same = ([], []), []
        slab = np.cumsum([len(p) for p in flat]) // TEXT_BYTES
        for _, some in groupby(range(len(flat)), slab.__getitem__):
            found, its = self.tokenised([flat[k] for k in some])
            for side, own in zip(sides, found):
                side.extend(own)
            same.extend(its)
        at, none = 0, np.zeros(0, np.int64)
        for text, parts in zip(texts, cut):
            own = slice(at, at + len(parts))
            at += len(parts)
            ids = tuple(np.concatenate([none, *side[own]]) for side in sides)
            whole = (" " + text).encode() if text and not all(same[own]) else None
            back = bool(text) if whole is None else all(
                b"".join(map(known.__getitem__, i.tolist())) == whole for known, i in zip((self.a_bytes, self.b_bytes), ids))
            out.append(ids if back else (none, none))
        return out


@cache
def _loaded(folder: str) -> Tokenizers:
    return Tokenizers(folder)


def diagonals(a: np.ndarray, b: np.ndarray, work: int) -> tuple[np.ndarray, np.ndarray]:
    """How many ends of ``a`` and of ``b`` come before each piece of the merge, and the totals
    last; of equal ends that of ``a`` comes first."""
    step = np.append(np.arange(0, len(a) + len(b), work), len(a) + len(b))
    low, high = np.maximum(0, step - len(b)), np.minimum(step, len(a))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        more = open_.copy()
        more[open_] = a[middle[open_]] <= b[step[open_] - middle[open_] - 1]
        low, high = np.where(more, middle + 1, low), np.where(open_ & ~more, middle, high)
    return low, step - low


def piece(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links and shared ends of one piece, from its own ends alone.

    Links as numbers of tokens in order of their end, the number of a token beyond the piece
    being its length, and which of ``a`` and of ``b`` end together.
    """
    behind = np.searchsorted(b, a, "left")  # the token of b that holds the last byte of each a
    above = np.searchsorted(a, b, "right")
    a_shared = np.zeros(len(a), dtype=bool)
    inside = behind < len(b)
    a_shared[inside] = b[behind[inside]] == a[inside]
    b_shared = np.zeros(len(b), dtype=bool)
    b_shared[above > 0] = a[above[above > 0] - 1] == b[above > 0]
    own = ~b_shared
    links = np.concatenate([np.arange(len(a)), above[own]]), np.concatenate([behind, np.flatnonzero(own)])
    order = np.argsort(np.concatenate([a, b[own]]), kind="stable")
    return links[0][order], links[1][order], a_shared, b_shared


def merged(a: np.ndarray, b: np.ndarray, work: int = WORK):
    """Links (token numbers of both sides) and shared ends of two lists of ends, piece by piece."""
    i, j = diagonals(a, b, work)
    link_a, link_b, a_shared, b_shared = [], [], np.zeros(len(a), dtype=bool), np.zeros(len(b), dtype=bool)
    for k in range(len(i) - 1):
        one, other, shared, its = piece(a[i[k]: i[k + 1]], b[j[k]: j[k + 1]])
        a_shared[i[k]: i[k + 1]], b_shared[j[k]: j[k + 1]] = shared, its
        one, other = one + i[k], other + j[k]
        if 0 < i[k] and j[k] < j[k + 1] and a[i[k] - 1] == b[j[k]]:  # the last end of the piece before
            a_shared[i[k] - 1] = b_shared[j[k]] = True
            first = int(np.flatnonzero(other == j[k])[0])
            one, other = np.delete(one, first), np.delete(other, first)
        link_a.append(one)
        link_b.append(other)
    none = np.zeros(0, np.int64)
    return np.concatenate([*link_a, none]), np.concatenate([*link_b, none]), a_shared, b_shared


class Aligned:
    """The tokens of some texts with their links and groups."""

    def __init__(self, known: Tokenizers, texts: list[str | None]):
        ids = known.encoded(texts)
        self.known = known
        self.n_a, self.n_b = (np.array([len(x[side]) for x in ids], np.int64) for side in (0, 1))
        self.a, self.b = (np.concatenate([*[x[side] for x in ids], np.zeros(0, np.int64)]) for side in (0, 1))
        # Both sides of a text have the same bytes, so ends go on from text to text alike.
        self.link_a, self.link_b, self.a_shared, self.b_shared = merged(
            np.cumsum(known.a_length[self.a]), np.cumsum(known.b_length[self.b]))
        self.at_a, self.at_b = _starts(self.n_a), _starts(self.n_b)
        self.link_doc = np.searchsorted(self.at_a, self.link_a, "right") - 1
        self.n_links = np.bincount(self.link_doc, minlength=len(texts))
        self.n_groups = np.diff(_starts(self.a_shared)[self.at_a])

    def groups_sha256(self) -> list[str]:
        """Digest of ``a1,a2|b1;a3|b2,b3`` of every text."""
        stop_a, stop_b = (np.concatenate([[0], np.flatnonzero(s) + 1]) for s in (self.a_shared, self.b_shared))
        group_a, group_b = (np.cumsum(s) - s for s in (self.a_shared, self.b_shared))
        out = np.empty(len(self.a) + len(self.b), object)
        out[np.arange(len(self.a)) + stop_b[group_a]] = self.known.a_text[2 * self.a + self.a_shared]
        out[np.arange(len(self.b)) + stop_a[group_b + 1]] = self.known.b_text[2 * self.b + self.b_shared]
        at = self.at_a + self.at_b
        return [hashlib.sha256(b"".join(out[s:e].tolist())[:-1]).hexdigest() if e > s else "" for s, e in zip(at, at[1:])]

    def groups(self) -> pa.Array:
        """Per text a list of groups, each with the ids of A and of B."""
        sides = []
        for ids, shared in ((self.a, self.a_shared), (self.b, self.b_shared)):
            stops = np.concatenate([[0], np.flatnonzero(shared) + 1])
            sides.append(pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.array(ids, pa.int32())))
        both = pa.StructArray.from_arrays(sides, ["a", "b"])
        return pa.ListArray.from_arrays(pa.array(_starts(self.n_groups), pa.int32()), both)

    def pairs(self) -> tuple[pa.Array, pa.Array]:
        """Per text its linked pairs of ids, each once, and how many links hold them."""
        pair = self.a[self.link_a] << PAIR_BITS | self.b[self.link_b]
        distinct, times = np.unique(self.link_doc << 40 | pair, return_counts=True)
        at = np.searchsorted(distinct >> 40, np.arange(len(self.n_a) + 1))
        at = pa.array(at, pa.int32())
        return (pa.ListArray.from_arrays(at, pa.array(distinct & ((1 << 40) - 1), pa.int64())),
                pa.ListArray.from_arrays(at, pa.array(times, pa.int32())))


LINKED = "__rid long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def linked(docs: DataFrame, folder: str = FOLDER, groups: bool = False) -> DataFrame:
    """Every row's numbers of tokens, groups and links, its linked ``pairs`` with ``times``, and
    on request the groups themselves; one pass over the texts, without a shuffle."""
    narrow = docs.select(
        F.monotonically_increasing_id().alias("__rid"), F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _loaded(folder)
        for batch in batches:
            for part in tokens.slices(batch, limit=TEXT_BYTES):
                found = Aligned(known, part.column("text").to_pylist())
                counts = [pa.array(c, pa.int64()) for c in (found.n_a, found.n_b, found.n_groups, found.n_links)]
                columns = [*part.columns[:2], *counts, pa.array(found.groups_sha256(), pa.string()), *found.pairs()]
                names = ["__rid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]
                if groups:
                    columns, names = [*columns, found.groups()], [*names, "groups"]
                yield pa.RecordBatch.from_arrays(columns, names)

    more = ", groups array<struct<a:array<int>,b:array<int>>>" if groups else ""
    return narrow.mapInArrow(run, f"{LINKED}, pairs array<long>, times array<int>{more}")


def pair_counts(rows: DataFrame) -> DataFrame:
    """``pair, n, best`` over all rows of ``linked``: the links of each pair of ids, and whether
    no other pair of its B id has more. A pair is the A id, shifted, and the B id."""
    each = rows.select(F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    counts = cut_lineage(each.groupBy(F.col("p.pairs").alias("pair")).agg(
        F.sum("p.times").alias("n")), "pair-counts")
    b = F.col("pair").bitwiseAND(F.lit((1 << PAIR_BITS) - 1))
    highest = counts.groupBy(b.alias("b")).agg(F.max("n").alias("highest"))
    return cut_lineage(counts.withColumn("b", b).join(highest, "b").select(
        "pair", "n", (F.col("n") == F.col("highest")).alias("best")), "pair-counts")


def frequent(counts: DataFrame, most: int = FREQUENT) -> pa.Table:
    """The pairs with at least ``2 ** k`` links, ``k`` the smallest that leaves ``most`` at most."""
    level = F.floor(F.log2(F.col("n")) + 1e-9).cast("int")
    by_level = sorted(counts.groupBy(level.alias("k")).count().collect(), reverse=True)  # 63 rows at most
    total, least = 0, 63
    for k, number in by_level:
        if total + number > most:
            break
        total, least = total + number, k
    rows = counts.filter(level >= least).select("pair", "n", "best").toArrow()
    return rows.sort_by("pair")


def scored(rows: DataFrame, counts: DataFrame, most: int = FREQUENT) -> DataFrame:
    """``rows`` with ``n_best`` and ``count_sum``: links whose pair is the best of its B id, and
    the corpus-wide counts of all links added up."""
    top = frequent(counts, most)
    shared = rows.sparkSession.sparkContext.broadcast(
        [top[c].to_numpy() for c in ("pair", "n", "best")])  # two megabytes at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = shared.value
        for batch in batches:
            lists, times = batch.column("pairs"), batch.column("times").flatten().to_numpy().astype(np.int64)
            pair, many = lists.flatten().to_numpy(), lists.value_lengths().to_numpy()
            at = _starts(many)
            place = np.minimum(np.searchsorted(known, pair), max(len(known) - 1, 0))
            hit = known[place] == pair if len(known) else np.zeros(len(pair), dtype=bool)
            place = place[hit]
            sums = []
            for value in (best[place].astype(np.int64), n[place].astype(np.int64)):
                part = np.zeros(len(pair), np.int64)
                part[hit] = value * times[hit]
                sums.append(pa.array(np.diff(_starts(part)[at])))
            rest = pa.array(_starts(~hit)[at], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], *sums,
                 pa.ListArray.from_arrays(rest, pa.array(pair[~hit], pa.int64())),
                 pa.ListArray.from_arrays(rest, pa.array(times[~hit], pa.int64()))],
                [*names, "n_best", "count_sum", "rest", "rest_times"])

    names = [c.split()[0] for c in LINKED.split(", ")]
    looked = cut_lineage(rows.select(*names, "pairs", "times").mapInArrow(
        run, f"{LINKED}, n_best long, count_sum long, rest array<long>, rest_times array<long>"), "aligned")
    rare = looked.select("__rid", F.explode(F.arrays_zip("rest", "rest_times")).alias("p")).select(
        "__rid", F.col("p.rest").alias("pair"), F.col("p.rest_times").alias("times"))
    added = rare.join(counts, "pair").groupBy("__rid").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("n") * F.col("times")).alias("more_sum"))
    whole = looked.join(added, "__rid", "left")
    return whole.select(
        *names, (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"))


def aligned(docs: DataFrame, folder: str = FOLDER, most: int = FREQUENT) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row."""
    rows = cut_lineage(linked(docs, folder), "links")
    return scored(rows, pair_counts(rows), most).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
