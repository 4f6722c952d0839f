"""Documents that go wrong in every way the operators promise to bear, and brute-force helpers."""

import re
from itertools import combinations

from pyspark.sql.types import LongType, StringType, StructField, StructType

SPACE = "[^\\x20\\x09-\\x0D]+"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# Names that operators use themselves.
CLASHES = ("size score copies target shard h bytes row node label kept n_entities __id __row a.b").split()
SCHEMA = StructType(
    [StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
     StructField("source", StringType()), StructField("n_chars", LongType())]
    + [StructField(name, StringType()) for name in CLASHES])


def document(doc_id, text, lang="en", source="s"):
    return (doc_id, text, lang, source, len(text or ""), *["clash"] * (len(SCHEMA) - 5))


def messy_rows():
    long_text = " ".join(f"w{i % 5000} x{i % 7}" for i in range(60_000))
    copy = "one two three four five six seven eight nine ten eleven twelve"
    rows = [
        document(1, None), document(2, ""), document(3, " \n\t "), document(4, "short"),
        document(5, long_text, "en", "big"), document(6, copy), document(6, copy), document(7, copy, None, None),
        document(8, copy + " extra", "de", "t"), document(9, "12 34 -- !!", None, "t"),
        document(None, "a text without an id but with words in it", "en", None),
        document(10, "ONE Two THREE four five six seven eight nine ten eleven twelve", "en", "t"),
        document(11, "überall größere Äpfel und Öl für alle", "de", ""),
    ]
    return rows + [document(100 + i, f"same size {i}", "en", "t") for i in range(20)]


def messy(spark):
    return spark.createDataFrame(messy_rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return re.findall(SPACE, text or "")


def shingles(text, size):
    found = words((text or "").translate(UPPER))
    if not found:
        return set()
    if len(found) < size:
        return {tuple(found)}
    return {tuple(found[i: i + size]) for i in range(len(found) - size + 1)}


def components(sets, percent=80):
    """Smallest key reachable over links of similar sets, by comparing all pairs."""
    parent = {k: k for k in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return {k: root(k) for k in sets}
