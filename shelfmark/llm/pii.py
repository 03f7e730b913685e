"""Personal data in texts: strict patterns, and a weakly supervised classifier for looser forms. DataFrame expressions only.

Strict matches (``base``) are leftmost and non-overlapping for each kind and always stay. Around them, looser candidates are read
(written-out or defanged addresses, national telephone numbers, card numbers that stand in longer runs of digits or are shorter)
together with strict matches that fail their check. A loose candidate that touches a base span is dropped before any vote, and a
failed match that a loose candidate of its kind touches does not vote beside it, so that no evidence counts twice. Three labelers
vote: the form (digit counts, Luhn, octets), a gazetteer (top-level domains, calling codes, issuer ranges, public address ranges) and
the context: fixed cue words, else words and places in the line that the corpus itself shows before passing matches of the kind
rather than elsewhere. Expectation maximization over the vote patterns of the whole corpus estimates each labeler's reliability; a
candidate whose form fails is a known negative. A logistic classifier over the span's own features (form, listing, separators,
length, place, variety of characters), fitted to the posteriors of all candidates, decides which loose candidates are spans. What
reaches the driver are counts: at most 20,736 patterns, 32 places and 1000 words a kind.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import materialize

KINDS = ("email", "ip", "card", "phone")

# What is looked for. Quantifiers are possessive where nothing could be given back, so that no text makes the search
# quadratic or deep; \G lets a match begin where the last one ended.
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A cheap test that every text with a match passes.
STRICT_GUARD = {
    "email": "text LIKE '%@%'",
    "ip": r"text RLIKE r'[0-9]\.[0-9]++\.[0-9]++\.[0-9]'",
    "card": r"text RLIKE r'[0-9](?:[\x20-]?[0-9]){12}'",
    "phone": r"text RLIKE r'\+[0-9]'",
}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[\[({]at[\])}]\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|[\[({]dot[\])}])\x20?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]{1,3}+(?:[\[(]\.[\])][0-9]{1,3}+){3}",
    "card": r"(?<![0-9])(?:[0-9]{13,19}+|[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}([\x20-])[0-9]{6}\2[0-9]{5})(?![0-9])",
    "phone": r"(?<![0-9A-Za-z+./-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z-])",
}
LOOSE_GUARD = {
    "email": r"text RLIKE r'[\[({]at[\])}]'",
    "ip": r"text RLIKE r'[0-9][\[(]\.[\])][0-9]'",
    "card": STRICT_GUARD["card"],
    "phone": r"text RLIKE r'[0-9]{3}\)?[\x20.-]?[0-9]{3}[\x20.-][0-9]{4}'",
}
# Gazetteer and cue words, fixed values.
DOMAINS = "com|org|net|edu|gov|mil|int|info|biz|io|de|fr|es|it|nl|uk|us|eu|ch|at|be|pt|pl|se|no|dk|fi|cz|ie|ca|mx|br|ar|au|nz|jp|cn|in|kr|ru|tr|za"
CALLING = "1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|21[1-8]|35[0-9]|37[0-8]|38[0-9]|42[013]|852|853|88[06]|97[0-7]|99[2-68]"
ISSUERS = "4|5[1-5]|2[2-7]|3[47]|6011|65|35"
GAZETTEER = {
    "email": rf"(?i)(?:\.|dot[\])}}]\x20?)(?:{DOMAINS})$",
    "ip": r"^(?!0*(?:0|22[4-9]|2[3-5][0-9])[^0-9])",
    "card": rf"^(?:{ISSUERS})",
    "phone": rf"^(?:\+(?:{CALLING})|\(?[2-9])",
}
CUES = {
    "email": "mail|contact|correo|courriel|write|schreib|from|cc",
    "ip": "ip|host|server|addr|adresse|login|ping|client",
    "card": "card|visa|master|amex|pay|karte|carte|tarjeta|credit",
    "phone": "tel|phone|call|fax|mobil|cell|handy|telefon|whatsapp|sms",
}
AGAINST = "version|isbn|issn|order|invoice|serial|ticket|commit|build|section|page|figure|doi"

FOUND = "array<struct<m:string,b:string,s:int,e:int>>"
YES, NO, SILENT = 1, 0, 2
#: Posterior of a candidate whose form fails.
FAILED = 0.02


def matches(pattern: str, guard: str) -> str:
    """SQL for the matches of a pattern in ``text``: m (the match), b (up to 40 characters before it), s, e (code points).

    Matches and the pieces between them come from the same search, so the offsets are their running lengths.
    """
    pairs = f"zip_with(regexp_extract_all(text, r'{pattern}', 0), split(text, r'{pattern}', -1), (m, g) -> named_struct('m', m, 'g', g))"
    step = "named_struct('at', a.at + char_length(x.g) + char_length(x.m), 'out', array_append(a.out, named_struct('m', x.m, 'b', right(x.g, 40), 's', a.at + char_length(x.g), 'e', a.at + char_length(x.g) + char_length(x.m))))"
    none = f"CAST(array() AS {FOUND})"
    run = f"aggregate(filter({pairs}, x -> x.m IS NOT NULL), named_struct('at', 0, 'out', {none}), (a, x) -> {step}, a -> a.out)"
    return f"CASE WHEN {guard} THEN {run} ELSE {none} END"


def digits(m: str) -> str:
    return f"regexp_replace({m}, '[^0-9]', '')"


def luhn(d: str) -> str:
    one = f"CAST(substring({d}, char_length({d}) + 1 - i, 1) AS INT)"
    return f"aggregate(sequence(1, char_length({d})), 0, (a, i) -> a + IF(i % 2 = 1, {one}, {one} * 2 - IF({one} > 4, 9, 0))) % 10 = 0"


def strict_ok(kind: str, m: str) -> str:
    """SQL for the check that a strict match must pass."""
    d = digits(m)
    return {
        "email": "true",
        "ip": rf"{m} RLIKE r'^{OCTET}(?:\.{OCTET}){{3}}$'",
        "card": f"(char_length({d}) BETWEEN 16 AND 19 AND {luhn(d)})",
        "phone": f"char_length({d}) BETWEEN 8 AND 15",
    }[kind]


def loose_ok(kind: str, m: str) -> str:
    d = digits(m)
    plain = rf"regexp_replace({m}, r'[\[\]()]', '')"
    return {
        "email": "true",
        "ip": rf"{plain} RLIKE r'^{OCTET}(?:\.{OCTET}){{3}}$'",
        "card": f"(char_length({d}) BETWEEN 13 AND 19 AND {luhn(d)})",
        "phone": f"char_length({d}) = 10",
    }[kind]


def judged(kind: str, ok: str, loose: bool, x: str = "x") -> str:
    """SQL for a candidate: its span, the votes of form and gazetteer, the fixed cue, the word before it, its place and shape.

    Place: 0 first in its line, 1 after a word, 2 after a mark, 3 after a number. Shape: separators (up to 3), length and variety.
    """
    m = f"{x}.m"
    listed = f"IF({digits(m) if kind == 'card' else m} RLIKE r'{GAZETTEER[kind]}', {YES}, {NO})"
    near = f"lower({x}.b)"
    cue = f"CASE WHEN {near} RLIKE r'\\b(?:{AGAINST})' THEN {NO} WHEN {near} RLIKE r'\\b(?:{CUES[kind]})' THEN {YES} ELSE {SILENT} END"
    place = (
        rf"CASE WHEN {x}.b = '' OR {x}.b RLIKE r'\n[^\p{{L}}\p{{N}}]*$' THEN 0 WHEN {x}.b RLIKE r'\p{{L}}\x20$' THEN 1 "
        rf"WHEN {x}.b RLIKE r'\p{{N}}[^\p{{L}}\n]{{0,3}}$' THEN 3 ELSE 2 END"
    )
    marks = f"least(3, char_length(regexp_replace({m}, '[^ ()-]', '')))"
    length = f"CASE WHEN char_length({m}) < 12 THEN 0 WHEN char_length({m}) < 16 THEN 1 WHEN char_length({m}) < 24 THEN 2 ELSE 3 END"
    distinct = f"size(array_distinct(split(lower({m}), '')))"
    variety = f"CASE WHEN {distinct} < 5 THEN 0 WHEN {distinct} < 9 THEN 1 ELSE 2 END"
    return (
        f"named_struct('s', {x}.s, 'e', {x}.e, 'loose', {'true' if loose else 'false'}, 'kind', {KINDS.index(kind)}, 'form', IF({ok}, {YES}, {NO}), "
        rf"'listed', {listed}, 'cue', {cue}, 'word', regexp_extract({near}, r'(\p{{L}}+)[^\p{{L}}\n]*$', 1), 'place', {place}, "
        f"'shape', {marks} * 12 + {length} * 3 + {variety})"
    )


def touching(x: str, y: str) -> str:
    return f"{x}.s < {y}.e AND {y}.s < {x}.e"


def candidates(docs: DataFrame) -> DataFrame:
    """Add ``text`` (null: empty), ``base_<kind>`` (strict spans) and ``rest_<kind>`` (loose ones, and strict ones that fail)."""
    rows = docs.withColumn("text", F.coalesce("text", F.lit("")))
    for kind in KINDS:
        rows = rows.withColumn(f"_strict_{kind}", F.expr(matches(STRICT[kind], STRICT_GUARD[kind])))
        rows = rows.withColumn(f"_loose_{kind}", F.expr(matches(LOOSE[kind], LOOSE_GUARD[kind])))
    for kind in KINDS:
        ok = strict_ok(kind, "x.m")
        rows = rows.withColumn(f"base_{kind}", F.expr(f"transform(filter(_strict_{kind}, x -> {ok}), x -> {judged(kind, 'true', False)})"))
    rows = rows.withColumn("_taken", F.expr(f"concat({', '.join(f'base_{k}' for k in KINDS)})"))
    for kind in KINDS:
        free = f"filter(_loose_{kind}, x -> NOT exists(_taken, y -> {touching('x', 'y')}))"
        rows = rows.withColumn(f"_free_{kind}", F.expr(free))
        loose = f"transform(_free_{kind}, x -> {judged(kind, loose_ok(kind, 'x.m'), True)})"
        failed = f"filter(_strict_{kind}, x -> NOT {strict_ok(kind, 'x.m')} AND NOT exists(_free_{kind}, y -> {touching('x', 'y')}))"
        rows = rows.withColumn(f"rest_{kind}", F.expr(f"concat({loose}, transform({failed}, x -> {judged(kind, 'false', False)}))"))
    return rows.drop("_taken", *(f"_{s}_{k}" for k in KINDS for s in ("strict", "loose", "free")))


def learned_context(each: DataFrame, support: int = 20) -> tuple[list[list[str]], dict[tuple[int, int], int]]:
    """For each kind, words that speak for it; and the votes of (kind, place).

    A word speaks for a kind if it stands before at least ``support`` and a thousandth of its passing candidates, three times as
    often as before all others; so there are at most 1000 a kind. A place votes if passing and failing candidates of the kind, at
    least ``support`` of each, differ by a factor of two in their share of it.
    """
    counts = {(r["kind"], r["form"], r["place"]): r["count"] for r in each.groupBy("kind", "form", "place").count().collect()}
    whole = sum(counts.values())
    passing = [sum(n for (k, form, _), n in counts.items() if k == i and form == YES) for i in range(len(KINDS))]
    failing = [sum(n for (k, form, _), n in counts.items() if k == i and form == NO) for i in range(len(KINDS))]
    votes = {}
    for k, p in itertools.product(range(len(KINDS)), range(4)):
        if min(passing[k], failing[k]) >= support:
            yes, no = ((counts.get((k, form, p), 0) + 1) / (n + 4) for form, n in ((YES, passing[k]), (NO, failing[k])))
            votes[k, p] = YES if yes >= 2 * no else NO if no >= 2 * yes else SILENT
    own = [F.count(F.when((F.col("kind") == k) & (F.col("form") == YES), 1)).alias(f"n_{k}") for k in range(len(KINDS))]
    words = each.where("word != ''").groupBy("word").agg(F.count("*").alias("n"), *own)
    speaks = []
    for k in range(len(KINDS)):
        often = F.col(f"n_{k}") >= max(support, passing[k] / 1000)
        apart = F.col(f"n_{k}") * max(1, whole - passing[k]) >= (F.col("n") - F.col(f"n_{k}")) * 3 * passing[k]
        speaks.append(often & apart)
    found = words.where(F.expr("false") if not whole else F.reduce(F.array(*speaks), F.lit(False), lambda a, x: a | x))
    rows = found.select("word", F.array(*speaks).alias("for")).orderBy("word").collect()
    return [[r["word"] for r in rows if r["for"][k]] for k in range(len(KINDS))], votes


def pattern(words: list[list[str]], places: dict[tuple[int, int], int], x: Column) -> Column:
    """Number of a candidate's pattern: ((kind, form, listed, context) as votes, separators), then length, variety and place."""
    said = F.lit(SILENT)
    for (k, p), vote in places.items():
        said = F.when((x["kind"] == k) & (x["place"] == p), vote).otherwise(said)
    for k, some in enumerate(words):
        if some:
            said = F.when((x["kind"] == k) & F.array_contains(F.lit(some), x["word"]), YES).otherwise(said)
    context = F.when(x["cue"] != SILENT, x["cue"]).otherwise(said)
    votes = x["kind"] * 108 + x["form"] * 36 + x["listed"] * 12 + context * 4 + F.floor(x["shape"] / 12)
    return (votes * 48 + x["shape"] % 12 * 4 + x["place"]).cast("int")


def reliabilities(counts: dict[int, int], rounds: int = 50) -> tuple[dict[int, float], dict]:
    """Posterior of every seen vote pattern, and P(vote | class) of each labeler for each kind, by expectation maximization.

    Patterns whose form fails are no personal data, by definition: their posterior stays where it is and holds the classes apart.
    """
    seen = {c: (c // 108, (c // 36 % 3, c // 12 % 3, c // 4 % 3)) for c in counts}
    post = {}
    for c, (_, v) in seen.items():
        said = [x for x in v if x != SILENT]
        post[c] = sum(said) / len(said) * 0.9 + 0.05 if v[0] != NO else FAILED
    model: dict = {}
    for _ in range(rounds):
        for k in range(len(KINDS)):
            mass, share = [1.0, 1.0], {}
            # Prior counts: labelers are better than chance, and silence says nothing.
            votes_of = {(j, y, x): (4.0 if x == y else 2.0 if x == SILENT else 1.0) for j in range(3) for y in (0, 1) for x in (0, 1, 2)}
            for c, (kind, v) in seen.items():
                if kind == k:
                    for y, p in ((1, post[c]), (0, 1 - post[c])):
                        mass[y] += counts[c] * p
                        for j, x in enumerate(v):
                            votes_of[j, y, x] += counts[c] * p
            for j, y in itertools.product(range(3), (0, 1)):
                whole = sum(votes_of[j, y, x] for x in (0, 1, 2))
                for x in (0, 1, 2):
                    share[j, y, x] = votes_of[j, y, x] / whole
            model[k] = (mass[1] / sum(mass), share)
        for c, (k, v) in seen.items():
            if v[0] == NO:
                continue
            prior, share = model[k]
            odds = math.log(prior / (1 - prior)) + sum(math.log(share[j, 1, x] / share[j, 0, x]) for j, x in enumerate(v))
            post[c] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return post, model


#: Weights of the classifier: for each kind, form with listing (4), separators (4), length (4), variety (3), place (4).
WEIGHTS = 4 * 19


def features(c, whole=np.floor_divide):
    """Positions of the weights of a pattern's span features, for an array of patterns or, with ``whole`` for Columns, a Column."""
    votes, rest = whole(c, 48), c % 48
    kind, form, listed = whole(votes, 108) * 19, whole(votes, 36) % 3, whole(votes, 12) % 3
    return [kind + form * 2 + listed, kind + 4 + votes % 4, kind + 8 + whole(rest, 12), kind + 12 + whole(rest, 4) % 3, kind + 15 + rest % 4]


def classifier(counts: dict[int, int], post: dict[int, float], rounds: int = 600) -> list[float]:
    """Weights of a logistic regression of the posteriors on the span features, each pattern weighing as the root of its count."""
    w, size = np.zeros(WEIGHTS), np.full(WEIGHTS, 1e-6)
    if not counts:
        return w.tolist()
    codes = np.array(sorted(counts))
    at = np.stack(features(codes), axis=1)
    goal = np.array([post[int(c) // 48] for c in codes])
    weight = np.sqrt([counts[int(c)] for c in codes])
    weight /= weight.sum()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(w[at].sum(axis=1), -30, 30)))
        g = 1e-4 * w + np.bincount(at.ravel(), np.repeat(weight * (p - goal), at.shape[1]), WEIGHTS)
        size += g * g
        w -= 0.3 * g / np.sqrt(size)
    return w.tolist()


def learn(rows: DataFrame) -> tuple[list[list[str]], dict[tuple[int, int], int], list[float]]:
    """Words, place votes and weights from all candidates of ``rows`` (made by ``candidates``)."""
    every = F.concat(*(F.col(f"{p}_{k}") for p in ("base", "rest") for k in KINDS))
    each = rows.select(every.alias("all")).where(F.size("all") > 0).select(F.inline("all"))
    words, places = learned_context(each)
    number = pattern(words, places, F.struct(*each.columns))
    counts = {r[0]: r[1] for r in each.groupBy(number.alias("code")).count().collect()}  # at most 20,736 patterns
    votes: dict[int, int] = {}
    for c, n in counts.items():
        votes[c // 48] = votes.get(c // 48, 0) + n
    post, _ = reliabilities(votes)
    return words, places, classifier(counts, post)


def find(docs: DataFrame, threshold: float = 0.9, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``text`` (null: empty) and, for each kind, ``base_<kind>`` and ``found_<kind>``: arrays of spans (s, e).

    ``found`` holds the base spans and the loose ones the classifier accepts, sorted; a loose span that touches a base span of
    any kind is left out, as is one whose form fails or that a fixed word before it speaks against. Candidates are written once to
    the shared folder, with the texts unless ``keep_text`` is false, which drops them. Rows stand for themselves, so repeated rows
    get equal spans; an empty table gives no rows. Other columns stay, but ones with the names used here are replaced.
    """
    rows = candidates(docs)
    rows = materialize(rows if keep_text else rows.drop("text"), "candidates")
    words, places, weights = learn(rows)
    sure = math.log(threshold / (1 - threshold))

    def accepted(x: Column) -> Column:
        parts = features(pattern(words, places, x), lambda c, n: F.floor(c / n).cast("int"))
        score = sum((F.get(F.lit(weights), p) for p in parts[1:]), F.get(F.lit(weights), parts[0]))
        return x["loose"] & (x["form"] == YES) & (x["cue"] != NO) & (score >= sure)

    out = rows
    for k in KINDS:
        extra = F.concat(F.col(f"base_{k}"), F.filter(f"rest_{k}", accepted))
        out = out.withColumn(f"found_{k}", F.array_sort(F.transform(extra, lambda x: F.struct(x["s"], x["e"]))))
    for k in KINDS:
        out = out.withColumn(f"base_{k}", F.transform(f"base_{k}", lambda x: F.struct(x["s"], x["e"])))
    return out.drop(*(f"rest_{k}" for k in KINDS))


def listed(prefix: str) -> Column:
    """kind:start:end of all spans, by kind, then start, comma-joined."""
    parts = [F.expr(f"transform({prefix}_{k}, x -> concat_ws(':', '{k}', x.s, x.e))") for k in KINDS]
    return F.array_join(F.concat(*parts), ",")


def mask(found: DataFrame) -> DataFrame:
    """The rows of ``find`` with every span in ``text`` replaced by its kind in brackets; overlapping spans get one mark."""
    marked = [F.expr(f"transform(found_{k}, x -> named_struct('s', x.s, 'e', x.e, 'mark', '[{k.upper()}]'))") for k in KINDS]
    spans = F.array_sort(F.concat(*marked))
    put = (
        "aggregate(_spans, named_struct('at', 0, 'out', ''), (a, x) -> IF(x.s < a.at, named_struct('at', greatest(a.at, x.e), 'out', a.out), "
        "named_struct('at', x.e, 'out', concat(a.out, substring(text, a.at + 1, x.s - a.at), x.mark))), "
        "a -> concat(a.out, substring(text, a.at + 1)))"
    )
    rows = found.withColumn("_spans", spans)
    rows = rows.withColumn("text", F.when(F.size("_spans") == 0, F.col("text")).otherwise(F.expr(put)))
    return rows.drop("_spans", *(f"{p}_{k}" for k in KINDS for p in ("base", "found")))
