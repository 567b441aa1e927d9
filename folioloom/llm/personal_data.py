"""Personal data by weak supervision: labelers vote on candidate spans, their reliabilities are estimated, and a
span classifier trained on the outcome decides what is added to the base patterns' finds.

Base finds (e-mail, IP, card and phone, by fixed patterns and checks) always stay. Candidates are wider: spelled-out or
international addresses, defanged and IPv6 numbers, and digit groups that the base patterns or checks pass over,
besides the base finds themselves, which the labelers learn from. Five labelers vote for, against or not at
all: the form (a base pattern with its check), the number's own check (Luhn, octets, digit counts), a gazetteer (top-level domains,
issuer prefixes, calling codes), the words before the span, and what touches it. Expectation-maximisation takes
the counts of vote patterns over all candidates of the corpus and gives each labeler a reliability for each kind and
each candidate a probability; a logistic classifier over votes and shapes is then fitted to these probabilities.

Native: patterns, votes and scores are DataFrame functions inside the row; no text is exchanged. Only counts per pattern
of votes and shape meet, at most 4 x 2 x 3**5 x 4 of them whatever the corpus, and the two fits run over these counts.
Patterns are possessive and start at the edges of their character runs, so time is linear in the text; positions come
from sums over blocks of ``BLOCK`` spans, so millions of spans in one text stay feasible.

A null text is empty: no spans, counts of 0. Rows are judged one by one; null ids, repeated rows and ties change nothing. Equal
candidates get equal scores. An empty table gives an empty one, and without candidates nothing is added. Other columns pass
through; a column with one of the names made here is replaced.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioloom.session import write_once

#: Kinds in order, and their base patterns (possessive forms of the same languages; a match can only
#: begin where its first character class begins, or where the match before it ended).
KINDS = ["email", "ip", "card", "phone"]
LOCAL = r"[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"

#: Wider candidates.
WIDE_LOCAL = r"[\p{L}\p{N}._%+-]"
AT = r"(?:\x20?[\[({<]\x20?(?:at|@)\x20?[\])}>]\x20?|\x20at\x20|@)"
DOT = r"(?:\x20?[\[({<]\x20?(?:dot|\.)\x20?[\])}>]\x20?|\x20dot\x20|\.)"
WIDE = [
    rf"(?i:(?<!{WIDE_LOCAL}){WIDE_LOCAL}++{AT}[\p{{L}}\p{{N}}-]++(?:{DOT}[\p{{L}}\p{{N}}-]++)++)",
    r"(?i:(?<![0-9A-Za-z.:])[0-9]{1,3}(?:\x20?[\[(]\x20?(?:dot|\.)\x20?[\])]\x20?[0-9]{1,3}){3}(?![0-9]))",
    r"(?<![0-9A-Za-z:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![0-9A-Za-z:])",
    r"\([0-9]{2,5}\)(?:[\x20 ._/-]?[0-9])++",
    r"[0-9](?:[\x20 ._/-]?[0-9])++",
]
#: What the gazetteer knows.
DOMAINS = (
    "com net org edu gov mil int info biz name io co ai app dev me tv eu us uk ca au nz de at ch fr be nl lu es pt it ie se no dk fi is pl "
    "cz sk hu ro bg gr tr ru ua il in pk cn jp kr tw hk sg my id th vn ph br ar cl mx pe za ng ke eg ma local example test"
)
CALLING = "1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|21[1-368]|35[0-9]|37[0-9]|38[0-79]|42[013]|85[256]|88[06]|9[67][0-9]|99[2-8]"
ISSUERS = (
    r"(?:4[0-9]{12}(?:[0-9]{3})?(?:[0-9]{3})?|5[1-5][0-9]{14}|2[2-7][0-9]{14}|3[47][0-9]{13}|3(?:0[0-5]|[689][0-9])[0-9]{11,13}|"
    r"6(?:011|5[0-9]{2}|4[4-9][0-9])[0-9]{12,15}|35[0-9]{14}|62[0-9]{14,17})"
)
#: Words before a span that speak for a kind, and words that speak for other numbers.
CUES = {
    "email": "e-?mail|mail|mailto|contact|contacto|kontakt|correo|courriel|write|adresse|address",
    "ip": "ip|ipv4|ipv6|host|server|servidor|serveur|address|addr|ping|gateway",
    "card": "card|visa|mastercard|amex|credit|debit|karte|kreditkarte|carte|tarjeta|pan",
    "phone": "phone|tel|telephone|telefon|téléphone|teléfono|tél|call|fax|mobile|cell|handy|sms|whatsapp|ruf|appel|llama|llamar",
}
AGAINST = "version|v|isbn|issn|doi|order|invoice|ref|reference|serial|sku|license|licence|token|hash|sha|md5|id|page|chapter|section|year|line|row|rows|item|items"
VOTES = ["form", "check", "gazetteer", "context", "touch"]
SHAPES = 4
BLOCK = 128


# --- spans of a pattern ---


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where the body is a loop."""
    return F.get(F.transform(F.array(value), body), 0)


def sums_before(n: Column, first: Column) -> Column:
    """``first`` + the sum of all elements before each one, by blocks, so that no long prefix is added up twice."""
    add = lambda a: F.aggregate(a, F.lit(0).cast("bigint"), lambda s, x: s + x)
    block = lambda v, b, size: F.slice(v, b * BLOCK + 1, size)

    def places(v: Column, per_block: Column) -> Column:
        return F.flatten(F.transform(per_block, lambda _, b: let(
            first + add(F.slice(per_block, F.lit(1), b)),
            lambda s: F.transform(block(v, b, F.lit(BLOCK)), lambda _, i: s + add(block(v, b, i))),
        )))

    def blocks(v: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int"))
        return F.transform(numbers, lambda b: add(block(v, b, F.lit(BLOCK))))

    return let(n, lambda v: let(blocks(v), lambda per_block: places(v, per_block)))


def matches(pattern: str, guard: Column, context: int = 0) -> Column:
    """(start, end, found[, before, after]) of every match in column ``text``, in code points, end exclusive."""
    text, p = F.col("text"), F.lit(pattern)
    kind = "start bigint, end bigint, found string" + (", before string, after string" if context else "")
    none = F.array().cast(f"array<struct<{', '.join(x.replace(' ', ': ') for x in kind.split(', '))}>>")

    def spans(found: Column, gaps: Column) -> Column:
        steps = F.zip_with(found, F.slice(gaps, F.lit(2), F.size(found)), lambda m, g: (F.length(m) + F.length(g)).cast("bigint"))

        def span(at: Column, m: Column, i: Column) -> Column:
            around = [F.right(gaps[i], F.lit(context)).alias("before"), F.substring(gaps[i + 1], 1, 4).alias("after")]
            return F.struct(at[i].alias("start"), (at[i] + F.length(m)).alias("end"), m.alias("found"), *(around if context else []))

        return let(sums_before(steps, F.length(gaps[0]).cast("bigint")), lambda at: F.transform(found, lambda m, i: span(at, m, i)))

    found = F.when(guard, F.regexp_extract_all(text, p, F.lit(0))).otherwise(F.array().cast("array<string>"))
    return let(found, lambda f: F.when(F.size(f) > 0, let(F.split(text, p, -1), lambda g: spans(f, g))).otherwise(none))


def digits(m: Column) -> Column:
    return F.regexp_replace(m, r"[^0-9]", "")


def valid(kind: str, m: Column) -> Column:
    """The base check of a match."""
    if kind == "ip":
        return m.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return F.length(digits(m)).between(16, 19) & luhn(digits(m))
    if kind == "phone":
        return F.length(digits(m)).between(8, 15)
    return F.lit(True)


def luhn(d: Column) -> Column:
    return F.call_function("luhn_check", d)


def with_base(df: DataFrame) -> DataFrame:
    """Arrays ``_email`` to ``_phone`` of (start, end)."""
    digit = F.col("text").rlike("[0-9]")
    guards = {"email": F.contains("text", F.lit("@")), "ip": digit, "card": digit, "phone": F.contains("text", F.lit("+"))}

    def found(kind: str) -> Column:
        good = F.filter(matches(BASE[kind], guards[kind]), lambda s: valid(kind, s["found"]))
        return F.transform(good, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))

    return df.withColumns({f"_{kind}": found(kind) for kind in KINDS})


# --- candidates and votes ---


def with_candidates(df: DataFrame) -> DataFrame:
    """``_all``: (kind, start, end, base, votes, shape) of every candidate, base finds among them."""
    guard = F.col("text").rlike(r"[0-9@]|(?i:[\[({<]\x20?at\x20?[\])}>]|\x20dot\x20)")
    # no \\G here: after a match of any alternative it would have the rest of a long run read again
    every = "|".join([BASE["email"].replace(r"\G|", ""), BASE["phone"], BASE["ip"], *WIDE])
    return df.withColumn("_all", F.filter(F.transform(matches(every, guard, context=48), judged), lambda c: c["kind"].isNotNull()))


def whole(kind: str, m: Column) -> Column:
    return m.rlike(rf"^(?:{BASE[kind]})$") & valid(kind, m)


def judged(s: Column) -> Column:
    """Kind, votes and shape of a candidate."""
    m, before = s["found"], F.lower(s["before"])
    d = digits(m)
    nd = F.length(d)
    numeric = m.rlike(r"^[+(]?[0-9][\x20 ()._/0-9-]*$")
    wide_card = (nd.between(16, 19) | (nd.between(13, 15) & luhn(d) & d.rlike(f"^{ISSUERS}$"))) & ~m.rlike(r"^[+(]|^00")
    kind = (
        F.when(whole("email", m), "email").when(whole("phone", m), "phone").when(whole("ip", m), "ip").when(whole("card", m), "card")
        .when(~numeric & m.rlike(r"(?i)@|\x20at\x20|[\[({<]\x20?at"), "email")
        .when(m.contains(":") | m.rlike(r"[\[(]\x20?(?i:dot|\.)"), "ip")
        .when(m.rlike(r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$"), "ip")
        .when(numeric & wide_card, "card")
        .when(numeric & nd.between(7, 15), "phone")
    )
    base = F.coalesce(F.element_at(F.create_map(*[x for k in KINDS for x in (F.lit(k), whole(k, m))]), kind), F.lit(False))
    vote = lambda yes, no: F.when(yes, 1).when(no, -1).otherwise(0)
    by_kind = lambda **of: F.coalesce(*[F.when(kind == k, v) for k, v in of.items()], F.lit(0))
    last = F.lower(F.regexp_extract(m, r"([\p{L}\p{N}-]+)$", 1))
    known = last.rlike(f"^(?:{DOMAINS.replace(' ', '|')})$")
    groups = F.size(F.split(m, r"[^0-9]+"))
    octets = m.rlike(rf"^{OCTET}(?:[^0-9A-Fa-f]+{OCTET}){{3}}$") | (m.contains(":") & m.rlike("[0-9]"))
    code = digits(F.regexp_extract(m, r"^(?:\+|00)\x20?(.*)$", 1))
    abroad, listed_code = m.rlike(r"^(?:\+|00)"), code.rlike(f"^(?:{CALLING})")
    local = m.rlike(r"^\([0-9]{2,5}\)[\x20.-]?[0-9]{3,4}[\x20.-]?[0-9]{3,5}$|^[0-9]{3}([.-])[0-9]{3}\1[0-9]{4}$")
    near = lambda some: before.rlike(rf"(?<![\p{{L}}\p{{N}}])(?:{some})[^\p{{L}}\p{{N}}]{{0,4}}(?:\p{{L}}{{1,6}}[^\p{{L}}\p{{N}}]{{1,3}})?$")
    no = F.lit(False)
    # where almost anything passes, passing is no vote for
    votes = [
        vote(base | ((kind == "phone") & local), kind.isin("card", "phone") & (groups > 7)),
        by_kind(email=vote(no, ~F.length(last).between(2, 24) | last.rlike("[0-9]")), ip=vote(octets, ~octets),
                card=vote(luhn(d), ~luhn(d)), phone=vote(no, ~nd.between(8, 15))),
        by_kind(email=vote(known, ~known), ip=vote(m.rlike(r"^(?:10|127|192\D+168|172\D+(?:1[6-9]|2[0-9]|3[01]))\D"), m.rlike(r"^0+\D")),
                card=vote(d.rlike(f"^{ISSUERS}$"), ~d.rlike(f"^{ISSUERS}$")), phone=vote(abroad & listed_code, abroad & ~listed_code)),
        by_kind(**{k: vote(near(CUES[k]), near(AGAINST)) for k in KINDS}),
        vote(no, s["before"].rlike(r"[\p{L}\p{N}_]$") | s["after"].rlike(r"^[\p{L}\p{N}_]")),
    ]
    # how the span is written: in one piece, in groups, spelled out or bracketed, with other letters or separators
    shape = F.when(m.rlike(r"^[A-Za-z0-9._%+@-]+$") & (groups < 3), 0).when(m.rlike(r"^[\x20()+0-9-]+$"), 1).when(m.rlike(r"(?i)[\[({<]|\x20(?:at|dot)\x20"), 2).otherwise(3)
    return F.struct(kind.alias("kind"), s["start"].alias("start"), s["end"].alias("end"), base.alias("base"), F.array(*votes).alias("votes"), shape.alias("shape"))


# --- reliabilities and the classifier ---


@dataclass(frozen=True)
class Pattern:
    kind: str
    base: bool
    votes: tuple[int, ...]
    shape: int
    count: int


def reliabilities(rows: list[Pattern], rounds: int = 50) -> tuple[dict[tuple[str, int], float], list[float]]:
    """(reliability of each labeler per kind, probability of each pattern) by expectation-maximisation.

    A labeler is right with its reliability whenever it votes, given the truth, independently of others. Base finds and
    others of a kind have a share of true spans each. Priors are eight right votes in ten, and one true
    candidate in four of those outside the base: they keep the two classes from changing places.
    """
    right = {(k, j): 0.8 for k in KINDS for j in range(len(VOTES))}
    share = {(k, b): 0.95 if b else 0.25 for k in KINDS for b in (False, True)}
    p = [0.0] * len(rows)
    for _ in range(rounds):
        for i, r in enumerate(rows):
            odds = math.log(share[r.kind, r.base]) - math.log1p(-share[r.kind, r.base])
            for j, v in enumerate(r.votes):
                odds += v * (math.log(right[r.kind, j]) - math.log1p(-right[r.kind, j]))
            p[i] = 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))
        for k, j in right:
            yes = sum(r.count * (x if r.votes[j] > 0 else 1 - x) for r, x in zip(rows, p, strict=True) if r.kind == k and r.votes[j])
            n = sum(r.count for r in rows if r.kind == k and r.votes[j])
            right[k, j] = (yes + 8) / (n + 10)
        for k, b in share:
            own = [(r.count, x) for r, x in zip(rows, p, strict=True) if (r.kind, r.base) == (k, b)]
            share[k, b] = (sum(n * x for n, x in own) + (9 if b else 1)) / (sum(n for n, _ in own) + (10 if b else 4))
    return right, p


def features(votes: tuple[int, ...], shape: int) -> list[int]:
    """Positions of the active features: a constant, one of three per labeler, one shape."""
    return [0, *(1 + 3 * j + v + 1 for j, v in enumerate(votes)), 1 + 3 * len(VOTES) + shape]


def fit(rows: list[Pattern], p: list[float], rounds: int = 400, step: float = 0.5, decay: float = 1e-3) -> dict[str, list[float]]:
    """Weights of a logistic classifier per kind, by gradient descent on the probabilities of all patterns.

    Patterns count by the root of their number, so that rare ways of writing are heard beside the base finds.
    """
    out = {}
    for kind in KINDS:
        own = [(features(r.votes, r.shape), x, math.sqrt(r.count)) for r, x in zip(rows, p, strict=True) if r.kind == kind]
        w = [0.0] * (1 + 3 * len(VOTES) + SHAPES)
        total = sum(c for _, _, c in own)
        for _ in range(rounds if own else 0):
            grad = [decay * x for x in w]
            for at, x, c in own:
                error = 1 / (1 + math.exp(-sum(w[i] for i in at))) - x
                for i in at:
                    grad[i] += c / total * error
            w = [x - step * g for x, g in zip(w, grad, strict=True)]
        out[kind] = w
    return out


def patterns(candidates: DataFrame) -> list[Pattern]:
    """Counts of vote patterns; at most 4 kinds x 2 x 3**5 votes x 4 shapes rows, from ``_all``."""
    each = candidates.select(F.explode("_all").alias("c")).select("c.kind", "c.base", "c.votes", "c.shape")
    rows = each.groupBy("kind", "base", "votes", "shape").agg(F.count(F.lit(1)).alias("count")).collect()
    return sorted((Pattern(r["kind"], r["base"], tuple(r["votes"]), r["shape"], r["count"]) for r in rows), key=lambda r: (r.kind, r.base, r.votes, r.shape))


def score(c: Column, weights: dict[str, list[float]]) -> Column:
    """Log-odds of a candidate."""
    table = F.create_map(*[x for k in KINDS for x in (F.lit(k), F.array(*[F.lit(float(w)) for w in weights[k]]))])
    w = F.element_at(table, c["kind"])
    total = w[0] + w[c["shape"] + (1 + 3 * len(VOTES))]
    for j in range(len(VOTES)):
        total = total + w[c["votes"][j] + (2 + 3 * j)]
    return total


def find(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``base`` and ``spans``: arrays of (kind, start, end) by kind, then start, in code points.

    ``base`` are the fixed patterns' finds, ``spans`` these and the classifier's. Without ``keep_text`` the text
    is left out of the result. Candidates are stored once beside the other columns and read for the counts and the scores.
    """
    other = [c for c in docs.columns if c not in ("base", "spans") and (keep_text or c != "text")]
    kept = F.struct(*(F.col(f"`{c}`") for c in other)) if other else F.struct(F.lit(0).alias("none"))
    rows = docs.select(kept.alias("_row"), F.coalesce("text", F.lit("")).alias("text"))
    rows = with_candidates(with_base(rows)).select("_row", *(f"_{k}" for k in KINDS), "_all")
    stored = write_once(rows, "personal-candidates")
    counts = patterns(stored)
    _, p = reliabilities(counts)
    weights = fit(counts, p)
    added = F.filter("_all", lambda c: ~c["base"] & (score(c, weights) > 0))

    def spans(kind: str, more: bool) -> Column:
        named = lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
        own = F.transform(f"_{kind}", named)
        if more:
            extra = F.transform(F.filter("_added", lambda c: c["kind"] == kind), named)
            own = F.when(F.size(extra) > 0, F.array_sort(F.concat(own, extra))).otherwise(own)
        return own

    stored = stored.withColumn("_added", added)
    return stored.select(
        *(F.col("_row")[c].alias(c) for c in other),
        F.concat(*(spans(k, False) for k in KINDS)).alias("base"),
        F.concat(*(spans(k, True) for k in KINDS)).alias("spans"),
    )


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
