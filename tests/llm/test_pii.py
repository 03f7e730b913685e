"""Personal data against Python's own search."""

import hashlib
import random
import re

from shelfmark.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    s = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (1 + i % 2)
        s += v - 9 * (v > 9)
    return s % 10 == 0


def brute(text):
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else False,
                "card": 16 <= len(d) <= 19 and luhn(d),
                "phone": 8 <= len(d) <= 15,
            }[kind]
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def texts():
    rng = random.Random(2)
    bits = ["a@b.c", "x.y+z@mail.example.com", "@", "a@b", "_x@y.z", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "0001.002.3.255",
            "4111 1111 1111 1111", "4111-1111-1111-1112", "4111111111111111", "+1 (555) 010-4477", "+123", "+49 30 1234567", "é", "😀", " ",
            "..", "-", "12", "+", "(", "7", "word", "\n", "3782 822463 10005"]
    out = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 12))) for _ in range(400)]
    return [*out, "", None, "a" * 50_000, "1" * 50_000, "+" * 3000, "a.b" * 9000 + "@c.d", "a@b" + ".c" * 20_000, "9 " * 20_000, "😀é" * 500 + " a@b.c"]


def test_base_equals_search(spark):
    rows = list(enumerate(texts())) + [(3, "a@b.c"), (3, "a@b.c"), (None, "1.2.3.4")]
    df = spark.createDataFrame([(d, t, "e", 1) for d, t in rows], "doc_id long, text string, base_email string, s int")
    got = pii.find(df).select("doc_id", pii.listed("base").alias("b"), pii.listed("found").alias("f")).collect()
    expected = sorted((d if d is not None else -1, ",".join(brute(t))) for d, t in rows)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.b) for r in got) == expected
    assert all(set(filter(None, r.b.split(","))) <= set(filter(None, r.f.split(","))) for r in got)


def test_loose_forms_and_mask(spark):
    strict = [(i, f"mail me at user{i}@mail.example.com or call +1 (555) 010-44{i:02d} now") for i in range(30)]
    rows = [*strict, (90, "call 555-010-4477 or write to jo [at] mail [dot] example [dot] com."), (91, "version 1.2.3.400 of 12 items"), (92, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in pii.find(df).select("doc_id", pii.listed("found").alias("f")).collect()}
    assert found[90].f == "email:30:66,phone:5:17"
    assert found[91].f == "" and found[92].f == ""
    texts = {r.doc_id: r.text for r in pii.mask(pii.find(df)).collect()}
    assert texts[0] == "mail me at [EMAIL] or call [PHONE] now"
    assert texts[91] == rows[-2][1] and texts[92] == ""


def card(stem):
    return next(stem + str(d) for d in range(10) if luhn(stem + str(d)))


def test_cards_inside_a_longer_run(spark):
    a, b, wrong = card("453201511283036"), card("554843335567891"), "4532015112830361"
    wrong = wrong if not luhn(wrong) else wrong[:-1] + "2"
    rows = [(i, f"the number {card(f'4{i:014d}')} is old") for i in range(40)] + [(100, f"both {a} {b} here"), (101, f"none {wrong} {wrong} here")]
    found = {r.doc_id: (r.b, r.f) for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).select(
        "doc_id", pii.listed("base").alias("b"), pii.listed("found").alias("f")).collect()}
    assert found[100] == ("", "card:5:21,card:22:38") and found[101] == ("", "")
    assert found[7][0] == found[7][1] == "card:11:27"


def test_each_match_votes_once(spark):
    rows = [(1, "+1 (555) 010-4477 and +1 (555) 010-4478 190.137.223.204"), (2, "7536784127813050 4845168114407329")]
    every = [x for r in pii.candidates(spark.createDataFrame(rows, "doc_id long, text string")).collect() for k in pii.KINDS for x in [*r[f"base_{k}"], *r[f"rest_{k}"]]]
    spans = sorted((x.kind, x.s, x.e, x.loose) for x in every)
    # The telephone inside the strict one is gone; the second strict one fails (it runs into the address) but its loose twin votes for it.
    assert spans == [(1, 40, 55, False), (2, 0, 16, True), (2, 17, 33, True), (3, 0, 17, False), (3, 25, 39, True)]


def test_context_is_learned(spark):
    # "ligne" stands before telephones only, "le" before everything; failing card numbers begin their lines, passing ones do not.
    rows = [(i, f"la ligne +33 1 23 45 67 {i:02d} et le u{i}@mail.example.com le 10.0.0.{i}\nle {card(f'4{i:014d}')}\n1234567812345678\n") for i in range(40)]
    c = pii.candidates(spark.createDataFrame(rows, "doc_id long, text string"))
    words, places, _ = pii.learn(c)
    assert words[pii.KINDS.index("phone")] == ["ligne"] and "le" not in sum(words, [])
    assert places[2, 0] == pii.NO and places[2, 1] == pii.YES and (3, 1) not in places


def test_long_loose_address_and_clashing_columns(spark):
    long = "x" * 150 + " [at] mail [dot] example [dot] com"
    rows = [(i, f"write to user{i}@mail.example.com", 1, "r") for i in range(30)] + [(50, f"write to {long}", 1, "r")]
    df = spark.createDataFrame(rows, "doc_id long, text string, s int, rest_email string")
    assert {r.doc_id: r.f for r in pii.find(df).select("doc_id", pii.listed("found").alias("f")).collect()}[50] == f"email:9:{9 + len(long)}"


def test_reliabilities():
    # Two labelers that agree and one that speaks at random: the random one is found out.
    counts = {c * 4: n for c, n in {(1 * 9 + 1 * 3 + 1): 100, (1 * 9 + 1 * 3): 100, 0: 300, 1: 300}.items()}
    post, model = pii.reliabilities(counts)
    share = model[0][1]
    assert min(post[c] for c in counts if c // 36 == 1) > 0.9 and max(post[c] for c in counts if c // 36 == 0) < 0.1
    assert abs(share[2, 1, 1] - share[2, 0, 1]) < 0.1 < share[0, 1, 1] - share[0, 0, 1]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert pii.mask(pii.find(df)).collect() == []
    assert pii.find(df, keep_text=False).collect() == []
    assert hashlib.sha256(b"").hexdigest() == spark.range(1).selectExpr("sha2('', 256)").first()[0]
