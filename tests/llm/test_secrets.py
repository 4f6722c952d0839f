"""Secret spans against a plain scan of each text."""

import hashlib
import random
import re

from strata.llm import secrets
from tests.llm import cases


def plain_spans(text):
    """Accepted spans of all kinds, weak ones only beside a complementary part."""
    text = text or ""
    found = []
    for kind, (pattern, rule) in secrets.KINDS.items():
        for m in re.finditer(pattern, text, re.ASCII):
            value = m.group()
            if rule == "group" and len(m.group(2)) < 6:
                continue
            if rule == "mixed" and not (
                    len(value) == 40 and re.search("[A-Z]", value) and re.search("[a-z]", value) and re.search("[0-9]", value)):
                continue
            found.append((m.start(), secrets.ORDER[kind], kind, m.end()))
    kept = []
    for start, order, kind, stop in sorted(found):
        others = secrets.COMPLEMENTS.get(kind)
        if others is None or any(
                k in others and s <= start + secrets.SCOPE and e >= start - secrets.SCOPE for s, _, k, e in found):
            kept.append((start, order, kind, stop))
    return sorted(kept)


def expected(doc_id, text):
    spans = plain_spans(text)
    entry = [f"{kind}:{start}:{stop}" for start, _, kind, stop in spans]
    base = [e for e in entry if e.split(":")[0] in secrets.BASE]
    counts = [sum(e.startswith(k + ":") for e in base) for k in secrets.BASE]
    return (doc_id, *counts, hashlib.sha256(",".join(base).encode()).hexdigest(), ",".join(entry), len(entry) - len(base))


def digest(spark, rows):
    docs = spark.createDataFrame(rows, cases.SCHEMA).repartition(3)
    columns = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_linked"]
    got = sorted((tuple(r) for r in secrets.scan(docs).select(*columns).collect()), key=repr)
    assert got == sorted((expected(r[0], r[1]) for r in rows), key=repr)
    return got


def test_random_texts(spark):
    rng = random.Random(8)
    key = "wJalrXUtnFEMI7K7MDENGbPxRfiCYEXAMPLEKEY1"
    parts = [
        "password=abcdef", "PassWord: 'zzzzzzz'", "secret=token:abcdefgh", "token: ab", "api_key == x=y=z/w",
        "apikey='1234567'", "AKIA" + "Q" * 16, "AKIA" + "7" * 15, "AKIAAKIA" + "Z" * 20, "0123456789abcdef" * 2, "abc" * 8,
        "abc" * 7, key, key + "Z", "user=bob", "Login: al.ice", "https://db.example.org/x?y=1", "host = cache.internal",
        "é" * 30, "\U0001f511" * 5, "x" * 300, "\n\n", "KKey", "ſecret=abcdefg",
    ]
    rows = [cases.document(i, " ".join(rng.choice(parts) for _ in range(rng.randrange(14)))) for i in range(400)]
    rows.append(cases.document(900, " ".join(rng.choice(parts) for _ in range(6000))))  # a very long text
    got = digest(spark, rows)
    assert sum(g[6] for g in got) > 200


def test_weak_parts_need_a_partner(spark):
    key = "wJalrXUtnFEMI7K7MDENGbPxRfiCYEXAMPLEKEY1"
    rows = [cases.document(1, key), cases.document(2, f"AKIA{'B' * 16} {key}"),
            cases.document(3, f"AKIA{'B' * 16} {'far ' * 200} {key}"), cases.document(4, "server: a.b.c")]
    got = {g[0]: g[5] for g in digest(spark, rows)}
    assert got == {1: "", 2: "access:0:20,key:21:61", 3: "access:0:20", 4: ""}
    links = secrets.scan(spark.createDataFrame(rows, cases.SCHEMA)).filter("doc_id = 2").first()["links"]
    assert [(k["start"], k["partner"]["start"], k["partner"]["distance"]) for k in links] == [(21, 0, 1)]


def test_messy_and_empty(spark):
    digest(spark, cases.messy_rows())
    assert secrets.scan(cases.empty(spark)).collect() == []
