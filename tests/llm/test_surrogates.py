"""Surrogates: type, format, gender, coreference and distinctness."""

import re

import pytest
from pyspark.sql import functions as F

from strata.llm import surrogates
from tests.llm import cases


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10


def replaced(spark, texts, key="k"):
    rows = [cases.document(i, t) for i, t in enumerate(texts)]
    out = surrogates.with_surrogates(spark.createDataFrame(rows, cases.SCHEMA).repartition(3), key)
    assert sorted(out.columns) == sorted(cases.SCHEMA.names)
    return [r["text"] for r in sorted(out.collect(), key=lambda r: r["doc_id"])]


def test_formats_and_coreference(spark):
    got = replaced(spark, [
        "mail ann.lee7@shop3.example.com, call +1 (988) 555-2485 or 988 555 2485.",
        "Again ANN.LEE7@shop3.example.com and bo@shop3.example.com; +1 (988) 555-2485",
        "card 4539 1488 0343 6467 or 4539-1488-0343-6467, bad card 4539148803436468, ssn 123-45-6789",
        "from 10.1.2.3, 192.168.7.9 and 42.144.35.254; version 1.2.3 stays, 3.14 too, 12345678 too",
    ])
    mail, same, other = [re.findall(r"\S+@[\w.]+\w", t) for t in got[:2]][0] + re.findall(r"\S+@[\w.]+\w", got[1])
    assert mail == same and mail != "ann.lee7@shop3.example.com"
    assert re.fullmatch(r"[a-z]{3}\.[a-z]{3}\d@[a-z]{4}\d\.[a-z]{7}\.com", mail)
    assert other.split("@")[1] == mail.split("@")[1] and re.fullmatch(r"[a-z]{2}", other.split("@")[0])
    phone = re.search(r"\+1 \((\d{3})\) (\d{3})-(\d{4}) or (\d{3}) (\d{3}) (\d{4})\.", got[0]).groups()
    assert phone[:3] == phone[3:] and phone != ("988", "555", "2485") * 2 and "555-2485" not in got[1]
    cards = re.findall(r"\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{4}", got[2])
    plain = [re.sub(r"\D", "", c) for c in cards]
    assert plain[0] == plain[1] != "4539148803436467" and plain[0][0] == "4" and cards[1].count("-") == 3
    assert luhn(plain[0]) == 0 == luhn("4539148803436467") and luhn(plain[2]) == luhn("4539148803436468") != 0
    assert re.search(r"ssn \d{3}-\d{2}-\d{4}", got[2]) and "123-45-6789" not in got[2]
    ips = re.findall(r"\d+\.\d+\.\d+\.\d+", got[3])
    assert ips[0].startswith("10.") and ips[1].startswith("192.168.") and "42.144.35.254" not in ips
    assert all(0 <= int(o) <= 255 for ip in ips for o in ip.split("."))
    assert "version 1.2.3 stays, 3.14 too, 12345678 too" in got[3]


def test_names_keep_gender_script_and_case(spark):
    got = replaced(spark, ["Mr. Ole Berg met Mrs Eva BERG. Later Mr Berg left.", "Dr. Ole Olsen; госпожа Анна Каренина; Frau Müller"])
    m = re.fullmatch(r"Mr\. (\S+) (\S+) met Mrs (\S+) (\S+)\. Later Mr (\S+) left\.", got[0])
    he, family, she, shouted, later = m.groups()
    assert he.split("-")[0] in surrogates.GIVEN["latin"]["m"] and she.split("-")[0] in surrogates.GIVEN["latin"]["f"]
    assert family == later != "Berg" and shouted == family.upper()
    assert re.search(r"госпожа [А-Я][а-я-]+(-[А-Я][а-я]+)? [А-Я][а-я]+; Frau [A-Z][a-z]+$", got[1]) and "Каренина" not in got[1]


def test_distinct_entities_stay_distinct(spark):
    # Far more addresses than two letters allow: later draws are longer, none collide.
    mails = [f"{a}{b}@x.org" for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnopqrstuvwxyz"]
    ips = [f"192.168.{i % 40}.{i // 40}" for i in range(1, 2000)]
    got = replaced(spark, [" ".join(mails), " ".join(ips)])
    new = [t.split(" ") for t in got]
    assert len(set(new[0])) == len(mails) and not set(new[0]) & set(mails)
    assert len(set(new[1])) == len(ips) and not set(new[1]) & set(ips)


def test_keys_and_reruns(spark):
    text = ["Herr Kurt Weber, kw@a.de, 4539148803436467"]
    assert replaced(spark, text) == replaced(spark, text) != replaced(spark, text, "another key")


def test_messy_and_empty(spark):
    docs = cases.messy(spark)
    out = surrogates.with_surrogates(docs, "k")
    kept = {c: 0 for c in ("a.b", "__id", "row")}
    rows = out.collect()
    assert all(r[c] == "clash" for r in rows for c in kept)
    assert sorted((repr(r["doc_id"]), r["text"] or "") for r in rows) == sorted(
        (repr(r[0]), r[1] or "") for r in cases.messy_rows())
    assert {r["n_entities"] for r in rows} == {0}
    assert surrogates.with_surrogates(cases.empty(spark), "k").collect() == []
    with pytest.raises(ValueError, match="need a key"):
        surrogates.with_surrogates(docs, "")


def test_whole_names_bare_mentions_and_foreign_numbers(spark):
    got = replaced(spark, [
        "Mr John Fitzgerald Kennedy spoke.", "Dr J. R. Smith wrote; Prof. A.B. Smith too.", "Mr Ole Berg came; Berg left, Bergen stayed.",
        "Señora Ana de la Cruz", "+33 1 23 45 67 89 or +44 20 7946 0958", "+49 30 1234567, +49 (30) 1234567 and +4930123456789",
        "Berg alone", "+1 212 555 0199 and 212-555-0199",
    ])
    assert not re.search("John|Fitzgerald|Kennedy", got[0]) and re.fullmatch(r"Mr \S+ \S+ \S+ spoke\.", got[0])
    found = re.fullmatch(r"Dr [A-Z]\. [A-Z]\. (\w+) wrote; Prof\. [A-Z]\. ?[A-Z]\. (\w+) too\.", got[1])
    assert found[1] == found[2] != "Smith"
    family = re.fullmatch(r"Mr \S+ (\w+) came; (\w+) left, Bergen stayed\.", got[2])
    assert family[1] == family[2] != "Berg"
    assert re.fullmatch(r"Señora \S+ de la \w+", got[3]) and "Cruz" not in got[3]
    assert re.fullmatch(r"\+33 \d \d\d \d\d \d\d \d\d or \+44 \d\d \d{4} \d{4}", got[4])
    assert not re.search("23 45 67 89|7946 0958", got[4])
    one, two = re.fullmatch(r"\+49 (\d\d \d{7}), \+49 \((\d\d\) \d{7}) and \+49\d{11}", got[5]).groups()
    assert one == two.replace(")", "") != "30 1234567"
    assert got[6] == "Berg alone"
    assert re.sub(r"\D", "", got[7][3:15]) == re.sub(r"\D", "", got[7][-12:]) != "2125550199"


def test_a_whole_range_of_addresses_ends(spark):
    mentions = spark.range(1 << 16).select(F.lit("ip").alias("kind"), F.concat_ws(
        ".", F.lit("192.168"), F.floor(F.col("id") / 256).cast("string"), (F.col("id") % 256).cast("string")).alias("value"))
    assert surrogates.redrawn(mentions, "k").count() == 0
    new = mentions.select("value", surrogates.draw(F.col("kind"), F.col("value"), "k", F.lit(0)).alias("new"))
    assert new.select("new").distinct().count() == 1 << 16
    assert new.filter("value = new OR NOT startswith(new, '192.168.')").count() == 0


@pytest.mark.parametrize("a, b", [(1, 7), (10, 10), (16, 3), (100, 10)])
def test_a_permutation_moves_every_number(spark, a, b):
    moved = spark.range(a * b).select("id", surrogates.permuted(
        F.col("id"), F.lit(a).cast("long"), F.lit(b).cast("long"), "k", F.lit("s")).alias("to")).collect()
    assert sorted(r["to"] for r in moved) == list(range(a * b))
    assert all(r["id"] != r["to"] for r in moved)


def plain_permutation(x, a, b, key, space):
    """The same permutation in plain Python."""
    import hashlib

    def shift(i, half):
        return int(hashlib.sha256("\x1f".join([key, space, str(i), str(half)]).encode()).hexdigest()[:15], 16)

    l, r = divmod(x, b)  # noqa: E741
    for i in range(4):
        l, r = ((l + shift(i, r)) % a, r) if i % 2 == 0 else (l, (r + shift(i, l)) % b)  # noqa: E741
    l, r = divmod((l * b + r + 1) % (a * b), b)  # noqa: E741
    for i in range(3, -1, -1):
        l, r = ((l - shift(i, r)) % a, r) if i % 2 == 0 else (l, (r - shift(i, l)) % b)  # noqa: E741
    return l * b + r


def test_texts_equal_a_plain_replacement(spark):
    """Numbers and private addresses of a text against a second implementation."""
    got = replaced(spark, ["ssn 123-45-6789 and 10.20.30.40, 192.168.7.9; 988 555 2485; +49 30 1234567; 4539 1488 0343 6467"])
    ssn = f"{plain_permutation(123456789, 10**5, 10**4, 'k', 'ssn/0'):09d}"
    ten, priv = plain_permutation(20 << 16 | 30 << 8 | 40, 256, 65536, "k", "ip10/0"), plain_permutation(7 << 8 | 9, 256, 256, "k", "ip192/0")
    at = plain_permutation((988 - 200) * 8_000_000 + (555_2485 - 2_000_000), 800, 8_000_000, "k", "usual/0")
    left, right = divmod(at, 8_000_000)
    home = f"{left + 200:03d}{right + 2_000_000:07d}"
    abroad = f"{plain_permutation(301234567, 10**5, 10**4, 'k', 'phone:499/0'):09d}"
    body = "4" + f"{plain_permutation(53914880343646, 10**7, 10**7, 'k', 'card/4/16/0'):014d}"
    card = body + str(-luhn(body + "0") % 10)
    card = " ".join(card[i: i + 4] for i in range(0, 16, 4))
    assert got == [f"ssn {ssn[:3]}-{ssn[3:5]}-{ssn[5:]} and 10.{ten >> 16}.{ten >> 8 & 255}.{ten & 255}, "
                   f"192.168.{priv >> 8}.{priv & 255}; {home[:3]} {home[3:6]} {home[6:]}; +49 {abroad[:2]} {abroad[2:]}; {card}"]
