"""The three operators of built-in functions against plain Python."""

import hashlib
import random
import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from caseledger.llm import licenses, pseudonyms, spotsigs

KEY = "k"


def brute_rounds(value, a, b, kind):
    left, right = divmod(value, b)
    for i in range(1, pseudonyms.ROUNDS + 1):
        half = right if i % 2 else left
        f = int(hashlib.sha256(f"{KEY}:{kind}:{i}:{half}".encode()).hexdigest()[:13], 16)
        if i % 2:
            left = (left + f) % a
        else:
            right = (right + f) % b
    return left * b + right


def digits(number, n, kind):
    return str(brute_rounds(number, 10 ** ((n + 1) // 2), 10 ** (n // 2), kind)).zfill(n)


def luhn(text):
    d = [int(c) for c in reversed(text)]
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(d)) % 10 == 0


def hidden(spark, texts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").withColumn("n_chars", F.length("text").cast("long")).withColumn("found", F.lit(1))
    return [r["text"] for r in pseudonyms.pseudonymize(docs, KEY, n_chars_col="n_chars").orderBy("doc_id").collect()]


def test_feistel_is_a_permutation(spark):
    out = spark.range(627 * 233).select(pseudonyms.feistel(F.col("id"), 627, 233, KEY, "date").alias("v"))
    assert out.distinct().count() == 627 * 233 and out.agg(F.max("v")).first()[0] == 627 * 233 - 1
    some = spark.range(50).select("id", pseudonyms.feistel(F.col("id") * 997, 65536, 65536, KEY, "ip").alias("v")).collect()
    assert all(r["v"] == brute_rounds(r["id"] * 997, 65536, 65536, "ip") for r in some)


def test_formats(spark):
    ip = brute_rounds(int.from_bytes(bytes([10, 1, 2, 254])), 65536, 65536, "ip").to_bytes(4)
    day = date(1800, 1, 1) + timedelta(brute_rounds((date(2024, 2, 29) - date(1800, 1, 1)).days, 627, 233, "date"))
    phone = digits(9885552485, 10, "phone")
    body = "4" + digits(int("41894974608791"[:14]), 14, "card16")
    texts = ["a +1 (988) 555-2485.", "x10.1.2.254!", "on 2024-02-29, 29/02/2024 and 29.02.2024", "1234567890123456 2023-02-30 999.1.1.1 4.0. 12", "123-45-6789"]
    got = hidden(spark, texts)
    assert got[0] == f"a +1 ({phone[:3]}) {phone[3:6]}-{phone[6:]}."
    assert got[1] == "x" + ".".join(map(str, ip)) + "!"
    assert got[2] == f"on {day:%Y-%m-%d}, {day:%d/%m/%Y} and {day:%d.%m.%Y}"
    assert got[3] == texts[3]
    s = digits(123456789, 9, "ssn")
    assert got[4] == f"{s[:3]}-{s[3:5]}-{s[5:]}"
    del body


def test_cards_stay_valid_and_linked(spark):
    rng, cards = random.Random(1), []
    while len(cards) < 60:
        n = rng.randrange(13, 20)
        c = "".join(rng.choice("0123456789") for _ in range(n))
        if luhn(c):
            cards.append(c)
    grouped = [f"{c[:4]} {c[4:8]} {c[8:12]} {c[12:]}" for c in cards if len(c) == 16]
    got = hidden(spark, [f"pay {c} now" for c in cards] + [f"pay {c} now" for c in grouped] + [f"{cards[0]} 12"])
    new = [re.sub("[^0-9]", "", t) for t in got[:60]]
    assert all(luhn(n) and len(n) == len(c) and n[0] == c[0] for n, c in zip(new, cards)) and sum(n == c for n, c in zip(new, cards)) < 5
    assert len(set(new)) == len(set(cards))
    assert [re.sub("[^0-9]", "", t) for t in got[60:-1]] == [n for n, c in zip(new, cards) if len(c) == 16]
    assert got[-1] == f"{new[0]} 12"


def test_mail_and_odd_rows(spark):
    got = hidden(spark, ["a.b@mail.example.com, A.B@mail.example.com x@y", None, "", "no data", "é" * 1000 + " 10.1.2.254"])
    a, b = re.findall(r"[a-z]+@mail.example.com", got[0])
    assert a == b and "a.b@" not in got[0] and got[0].endswith("x@y")
    assert got[1:4] == [None, "", "no data"] and "10.1.2.254" not in got[4]
    assert hidden(spark, []) == []


def words_of(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_scan(text):
    words = words_of(text)
    base = [(i, label) for p, label in licenses.PHRASES for i in range(len(words)) if words[i:i + len(p.split())] == p.split()]
    norm, found = f" {' '.join(words)} " if words else " ", []
    for nr, (label, word, pattern, priority, weight) in enumerate(licenses.rules()):
        if word in norm:
            for m in re.finditer(pattern, norm):
                found.append((norm[:m.start()].count(" "), norm[:m.start()].count(" ") + m.group().count(" "), priority, nr, label))
    def wins(a, b):
        inside = b[0] <= a[0] and a[1] <= b[1]
        return inside and (b[1] - b[0] > a[1] - a[0] or b[2] > a[2] or b[2] == a[2] and b[3] < a[3])
    kept = [a for a in found if not any(wins(a, b) for b in found)]
    return len(words), sorted(base), sorted(kept)


TEXTS = ["Released under the MIT License.", "Licensed under the Apache License, Version 2.0. Licensed under the Apache License, Version 2.0.", "Licensed under CC BY-NC 4.0.",
         "This work is licensed under the GNU General Public License, version 3.", "the GNU Lesser General Public License v2.1 applies", "SPDX-License-Identifier: BSD-3-Clause",
         "cc by nc cc by nc", "under the mit licenseé", "é UNDER THE MİT LICENSE", None, "", "!!!", "plain words " * 50, "https://www.apache.org/licenses/LICENSE-2.0 " * 3,
         "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "see license: mit license under the mit license under the mit license"]


def test_license_scan_matches_brute_force(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").selectExpr("*", "1 AS norm", "2 AS words", "3 AS gate")
    rows = {r["doc_id"]: r for r in licenses.scan_licenses(docs).collect()}
    for i, text in enumerate(TEXTS):
        n, base, kept = brute_scan(text)
        r = rows[i]
        assert r["n_words"] == n and sorted((b["start"], b["label"]) for b in r["base"]) == base, text
        assert sorted((d["start"], d["stop"], d["priority"], d["rule"], d["label"]) for d in r["detections"]) == kept, text
    assert len(licenses.rules()) > 300 and licenses.scan_licenses(docs.where("false")).count() == 0


# Texts that hold a rule's keyword, but none of the more common words of licenses.
RARE = ["Released under MIT terms", "distributed under the ISC", "published under zlib", "available at eclipse.org/legal/epl-v10", "scripts.sil.org/OFL",
        "licensed under the Creative Commons Attribution 4.0 license", "by the Creative Commons Attribution-ShareAlike 3.0 licence", "licence: Creative Commons Attribution NonCommercial",
        "released under Creative Commons Attribution-NonCommercial-NoDerivatives 4.0", "an open, common and public text in general"]


def test_license_scan_matches_patterns_tried_without_keywords(spark, monkeypatch):
    docs = spark.createDataFrame(list(enumerate(TEXTS + RARE)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in licenses.scan_licenses(docs).collect()}
    plain = [(label, "", pattern, priority, weight) for label, _, pattern, priority, weight in licenses.rules()]
    monkeypatch.setattr(licenses, "rules", lambda: plain)
    for i, text in enumerate(TEXTS + RARE):
        n, base, kept = brute_scan(text)
        assert sorted((d["start"], d["stop"], d["priority"], d["rule"], d["label"]) for d in rows[i]["detections"]) == kept, text
        assert rows[i]["n_words"] == n and sorted((b["start"], b["label"]) for b in rows[i]["base"]) == base, text
    labels = [{d["label"] for d in rows[len(TEXTS) + i]["detections"]} for i in range(len(RARE))]
    assert labels == [{"mit"}, {"isc"}, {"zlib"}, {"epl-1"}, {"ofl"}, {"cc-by"}, {"cc-by-sa"}, {"cc-by-nc"}, {"cc-by-nc-nd"}, set()]


def examples(parsed):
    """Texts that a parsed pattern matches: every branch, and every repeat as short and as long (at most once more)."""
    out = [""]
    for op, arg in parsed:
        op = str(op)
        if op == "LITERAL":
            here = [chr(arg)]
        elif op == "IN":
            here = [chr(arg[0][1])]
        elif op == "ANY":
            here = ["x"]
        elif op == "SUBPATTERN":
            here = examples(arg[3])
        elif op == "BRANCH":
            here = [x for branch in arg[1] for x in examples(branch)]
        elif op in ("MAX_REPEAT", "MIN_REPEAT"):
            here = [x * n for n in {arg[0], arg[0] + 1} for x in examples(arg[2])]
        else:
            assert op == "ASSERT"
            here = [" "]
        out = [a + b for a in out for b in here]
    return out


def test_whatever_a_license_rule_matches_holds_its_keyword():
    for label, word, pattern, _, _ in licenses.rules():
        for text in set(examples(re._parser.parse(pattern))):
            assert re.search(pattern, text) and word in text, (label, word, text)


def brute_signatures(text):
    words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
    out = set()
    for i, w in enumerate(words):
        if w in spotsigs.COMMON:
            chain = [x for x in words[i + 1:] if x not in spotsigs.COMMON][:spotsigs.CHAIN]
            if len(chain) == spotsigs.CHAIN:
                out.add(hashlib.md5(" ".join([w, *chain]).encode()).hexdigest()[:12])
    if not out and words:
        out = {hashlib.md5(" ".join(words).encode()).hexdigest()[:12]}
    return out


def test_signatures_and_next_rows(spark):
    rng = random.Random(6)
    vocabulary = ["the", "of", "and", "der", "la"] + [f"w{i}" for i in range(40)]
    rows = [(i * 3, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 60)))) for i in range(120)]
    rows += [(1000, None), (1001, ""), (1002, "the"), (1003, "ä of the b, c"), (1004, rows[5][1]), (-7, "of x y")]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS id", "2 AS range", "3 AS sigs")
    got = {r["doc_id"]: r for r in spotsigs.with_next(docs).collect()}
    order = sorted(rows, reverse=True)
    for k, (i, text) in enumerate(order):
        following = order[(k + 1) % len(order)][1] or ""
        assert set(got[i]["sigs"]) == brute_signatures(text) and got[i]["next_text"] == following, i
        assert set(got[i]["next_sigs"]) == brute_signatures(following)
    lone = spotsigs.with_next(docs.where("doc_id = 1003")).collect()
    assert lone[0]["next_text"] == lone[0]["text"] and spotsigs.with_next(docs.where("false")).count() == 0
    twice = spark.createDataFrame([(5, "a"), (5, "a"), (5, "b"), (None, "c"), (None, None), (9, "d")], "doc_id long, text string")
    assert spotsigs.with_next(twice).count() == 6


@pytest.mark.parametrize("threshold", [0.5, 0.8])
def test_near_pairs_match_brute_force(spark, threshold):
    rng, rows = random.Random(7), []
    for g in range(12):
        base = [rng.choice(["the", "of"]) if k % 3 == 0 else f"w{rng.randrange(300)}" for k in range(60)]
        for _ in range(4):
            text = list(base)
            for _ in range(rng.randrange(0, 6)):
                text[rng.randrange(60)] = f"v{rng.randrange(99)}"
            rows.append((len(rows), " ".join(text[:rng.randrange(45, 61)])))
    rows += [(100, ""), (101, None), (102, rows[0][1])]
    pairs, members = spotsigs.near_pairs(spark.createDataFrame(rows, "doc_id long, text string"), threshold=threshold)
    home = {r["doc_id"]: r["class"] for r in members.collect()}
    sets = {i: brute_signatures(t) for i, t in rows}
    classes = {home[i]: sets[i] for i in home if sets[i]}
    want = {(min(a, b), max(a, b)) for a in classes for b in classes
            if a != b and len(classes[a] & classes[b]) >= threshold * len(classes[a] | classes[b])}
    assert {(min(r["a"], r["b"]), max(r["a"], r["b"])) for r in pairs.collect()} == want and len(home) == len(rows)
    assert home[102] == home[0] and all((home[i] == home[j]) == (sets[i] == sets[j]) for i in home for j in home)


def test_near_pairs_of_equal_and_null_ids(spark):
    """Texts under one id, or none, are classes of their own and keep their own links."""
    words = [f"the w{k} x{k} y{k}" for k in range(40)]
    a, b = " ".join(words[:20]), " ".join(words[20:])
    near_a, near_b = a + " the extra one two", b + " the other one two"
    rows = [(7, a), (7, b), (8, near_a), (9, near_b), (None, a + " the last two words"), (None, "the lone text of few words here")]
    pairs, members = spotsigs.near_pairs(spark.createDataFrame(rows, "doc_id long, text string"))
    home = {(r["doc_id"], n): r["class"] for n, r in enumerate(members.orderBy("doc_id", "class").collect())}
    found = {frozenset((r["a"], r["b"])) for r in pairs.collect()}
    print_of = {t: spark.createDataFrame([(t,)], "t string").select(F.sha2(F.array_join(spotsigs.signatures(F.col("t")), ","), 256)).first()[0] for _, t in rows}
    assert set(home.values()) == set(print_of.values()) and len(home) == len(rows)
    assert frozenset((print_of[a], print_of[near_a])) in found and frozenset((print_of[b], print_of[near_b])) in found
    assert not any(print_of[x] in f and print_of[y] in f for f in found for x in (a, near_a) for y in (b, near_b))
