"""Secret scans over a trigram inverted index, with DataFrame operations only.

Every rule is a regular expression.  From its parse tree a Boolean query over trigrams is
derived: an OR of ANDs that every text with a match satisfies.  The index holds one posting
(trigram, document) for each trigram that some rule asks for and that the case-folded text has.
Postings are intersected per document and conjunct, the documents that satisfy a rule's query are
its candidates, and only they are verified with the regular expression itself.  A rule without a
mandatory trigram (here ``hex``) scans every text.

Matches are leftmost and do not overlap within a rule.  Their positions come from the lengths of
the matches and of the pieces between them, summed in blocks, so that a text with very many
matches costs neither a quadratic copy nor a shuffle of its own.

Patterns are read by Java's matcher and, for the query, by Python's parser: they must mean the
same in both.
"""

from __future__ import annotations

import itertools
import re._constants as sre
import re._parser as regex_parser
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeframe.llm.textcol import keyed

#: an AND is a set of trigrams, a query a set of ANDs; the empty AND holds for every text
Query = frozenset
EVERYTHING: Query = frozenset([frozenset()])

#: strings that one part of a pattern may stand for, before it counts as unknown
MOST_STRINGS = 64
#: ANDs in a query, and trigrams in an AND (a bit each); beyond that the query asks for less
MOST_ANDS, MOST_TRIGRAMS = 256, 62
#: matches whose positions are summed in one block
BLOCK = 1024


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds spans of ``kind``; a match counts if its ``group`` has ``least`` or more
    code points."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


def either_case(word: str) -> str:
    """A pattern for ``word`` with ASCII letters in either case, the same in every matcher."""
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in word)


_WORDS = "|".join([*map(either_case, ("password", "passwd", "secret", "token")),
                   f"{either_case('api')}_?{either_case('key')}"])

#: assign keeps the plain repetition: a value that is too short still uses up its text.  A run of
#: AKIA or hex that is too short holds no longer one, so there the length is in the pattern.
BASE = (
    Rule("assign", rf"""({_WORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)

#: well-known shapes of keys beyond the base
ADDED = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abeoprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_(live|test)_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url_login", r"://[^\x00-\x20/:@]{1,64}:[^\x00-\x20/:@]{1,64}@"),
)
RULES = BASE + ADDED


# ------------------------------------------------------------- trigram queries

def all_of(a: Query, b: Query) -> Query:
    """Both; where that is too many ANDs, the one with fewer (each alone is implied)."""
    if len(a) * len(b) > MOST_ANDS:
        return min(a, b, key=len) if EVERYTHING not in (a, b) else a if b == EVERYTHING else b
    return fewest({x | y for x in a for y in b})


def any_of(parts: Iterable[Query]) -> Query:
    ands = frozenset().union(*parts)
    return fewest(ands) if len(ands) <= MOST_ANDS else EVERYTHING


def fewest(ands: Iterable[frozenset]) -> Query:
    """Without the ANDs that another one implies."""
    kept: list[frozenset] = []
    for x in sorted(ands, key=len):
        if not any(k <= x for k in kept):
            kept.append(x)
    return frozenset(kept)


def has_any(strings: Iterable[str]) -> Query:
    """One of the strings is in the text.  Trigrams beyond ASCII ask for nothing, as folding may
    change them."""
    return any_of(frozenset([frozenset(list(t for i in range(len(s) - 2) if (t := s[i:i + 3]).isascii())[:MOST_TRIGRAMS])])
                  for s in strings)


def _item(op, arg) -> tuple[frozenset[str] | None, Query]:
    """(the folded strings that a part of a pattern can match, or None if many; its query)."""
    if op is sre.LITERAL:
        return frozenset([chr(arg).lower()]), EVERYTHING
    if op is sre.IN:
        chars: set[str] = set()
        for kind, value in arg:
            if kind is sre.LITERAL:
                chars.add(chr(value).lower())
            elif kind is sre.RANGE and value[1] - value[0] < MOST_STRINGS:
                chars |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
            else:
                return None, EVERYTHING
        return (frozenset(chars), EVERYTHING) if len(chars) <= MOST_STRINGS else (None, EVERYTHING)
    if op is sre.SUBPATTERN:
        return _sequence(arg[-1])
    if op is sre.BRANCH:
        found = [_sequence(x) for x in arg[1]]
        strings = None if any(s is None for s, _ in found) else frozenset().union(*(s for s, _ in found))
        if strings is not None and len(strings) <= MOST_STRINGS:
            return strings, has_any(strings)
        return None, any_of(q for _, q in found)
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
        low, high, inner = arg
        strings, query = _sequence(inner)
        if strings is not None and high in (0, 1) or strings is not None and low == high and len(strings) ** low <= MOST_STRINGS:
            times = [frozenset(map("".join, itertools.product(sorted(strings), repeat=n))) for n in {low, int(high)}]
            return frozenset().union(*times), EVERYTHING
        return None, query if low else EVERYTHING
    if op is sre.AT:
        return frozenset([""]), EVERYTHING
    return None, EVERYTHING


def _sequence(items) -> tuple[frozenset[str] | None, Query]:
    run, query, whole = frozenset([""]), EVERYTHING, True
    for op, arg in items:
        strings, own = _item(op, arg)
        if strings is not None and len(run) * len(strings) <= MOST_STRINGS:
            run = frozenset(a + b for a in run for b in strings)
            continue
        whole = False
        query = all_of(all_of(query, has_any(run)), own)
        run = strings if strings is not None else frozenset([""])
    return run if whole else None, all_of(query, has_any(run))


def trigram_query(pattern: str) -> Query:
    """The ORs of ANDs of lower-case trigrams that every text with a match satisfies."""
    return _sequence(regex_parser.parse(pattern))[1]


# ------------------------------------------------------------- index and candidates

def postings(docs: DataFrame, trigrams: Sequence[str]) -> DataFrame:
    """(trigram, key, th): the given trigrams that each text of ``docs(key, th, text)`` has when
    ASCII letters are folded."""
    low = docs.select("key", "th", F.lower("text").alias("low"))
    has = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in sorted(trigrams)]))
    return low.select(F.explode(has).alias("trigram"), "key", "th")


#: columns of a trigram that a rule asks for
TERM = {"trigram": "string", "kind": "string", "number": "int", "bit": "long", "full": "long"}


def candidates(docs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(key, th, kinds): for each document the rules whose trigram query it satisfies, of those
    that have one.  Postings are intersected by the bits that the trigrams of an AND have; the key
    of that grouping is the document, so a trigram that most documents have is no hot group."""
    asked = {r.kind: q for r in rules if (q := trigram_query(r.pattern)) != EVERYTHING}
    terms = [(t, kind, number, 1 << bit, (1 << len(x)) - 1) for kind, q in asked.items()
             for number, x in enumerate(sorted(map(sorted, q))) for bit, t in enumerate(x)]
    if not terms:
        return docs.where(F.lit(False)).select("key", "th", F.array().cast("array<string>").alias("kinds"))
    row = lambda t: F.struct(*[F.lit(v).cast(kind).alias(c) for v, (c, kind) in zip(t, TERM.items())])
    # as many rows as the rules have trigrams
    wanted = F.broadcast(docs.sparkSession.range(1).select(F.inline(F.array(*map(row, terms)))))
    met = (postings(docs, sorted({t[0] for t in terms})).join(wanted, "trigram")
           .groupBy("key", "th", "kind", "number", "full").agg(F.bit_or("bit").alias("bits"))
           .where(F.col("bits") == F.col("full")))
    return met.groupBy("key", "th").agg(F.collect_set("kind").alias("kinds"))


# ------------------------------------------------------------- verification

SPAN = "struct<start:long,end:long>"


def match_spans(text: Column, rule: Rule) -> Column:
    """array<struct<start, end>> of the rule's matches in code points, end exclusive."""
    pattern = F.lit(rule.pattern)
    chars = lambda a: F.transform(a, lambda s: F.char_length(s).cast("long"))
    size = chars(F.regexp_extract_all(text, pattern, F.lit(0)))
    own = chars(F.regexp_extract_all(text, pattern, F.lit(rule.group))) if rule.group else size
    gap = chars(F.split(text, rule.pattern, -1))
    steps = F.arrays_zip(gap.alias("gap"), size.alias("size"), own.alias("own"))
    none = F.array().cast(f"array<{SPAN}>")

    def step(at: Column, s: Column) -> Column:
        start = at["pos"] + s["gap"]
        span = F.struct(start.alias("start"), (start + s["size"]).alias("end"))
        return F.struct((start + s["size"]).alias("pos"),
                        F.when(s["own"] >= rule.least, F.concat(at["out"], F.array(span))).otherwise(at["out"]).alias("out"))

    def block(at: Column, part: Column) -> Column:
        inner = F.aggregate(part, F.struct(at["pos"].alias("pos"), none.alias("out")), step)
        return F.transform(F.array(inner), lambda x: F.struct(
            x["pos"].alias("pos"), F.concat(at["outs"], F.array(x["out"])).alias("outs")))[0]

    # the last step is the piece after the last match: no size, so its span is not kept
    whole = F.transform(F.array(steps), lambda z: F.transform(
        F.sequence(F.lit(0), F.call_function("div", F.size(z) - 1, F.lit(BLOCK)).cast("int")),
        lambda c: F.slice(z, c * BLOCK + 1, BLOCK)))[0]
    start = F.struct(F.lit(0).cast("long").alias("pos"), F.array().cast(f"array<array<{SPAN}>>").alias("outs"))
    return F.when(text.rlike(rule.pattern), F.flatten(F.aggregate(whole, start, block)["outs"])).otherwise(none)


def tagged(place: Column, kind: Column):
    return lambda s: F.struct(s["start"].alias("start"), place, s["end"].alias("end"), kind)


def spans(docs: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(doc_id, text, spans): per row of ``docs`` the spans of all rules, an array of (start, place
    of the rule, end, kind), ordered.

    A null text is empty; a null id is kept; repeated rows are rows, and rows that agree in id and
    text are one document of the index; an empty table gives no rows.  Spans of different
    rules may overlap.  Only the id and the text column are read."""
    rows = keyed(docs, id_col, text_col)
    joined = rows.join(candidates(rows, rules), ["key", "th"], "left")
    text = F.col("text")
    none = F.array().cast(f"array<{SPAN}>")
    found = []
    for place, rule in enumerate(rules):
        own = match_spans(text, rule)
        if trigram_query(rule.pattern) != EVERYTHING:
            own = F.when(F.array_contains("kinds", rule.kind), own).otherwise(none)
        tag = [F.lit(place).alias("place"), F.lit(rule.kind).alias("kind")]
        found.append(F.transform(own, tagged(*tag)))
    return joined.select("doc_id", "text", F.array_sort(F.flatten(F.array(*found))).alias("spans"))


def listed(found: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scanned(docs: DataFrame, added: Sequence[Rule] = ADDED, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """Query op11: doc_id, n_assign, n_access, n_hex, base_sha256, spans (see :func:`spans`)."""
    base = F.filter("spans", lambda s: s["place"] < len(BASE))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return spans(docs, (*BASE, *added), id_col, text_col).select(
        "doc_id", *[count(r.kind).alias(f"n_{r.kind}") for r in BASE],
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


# ------------------------------------------------------------- DuckDB SQL

def scan_sql(rules: Sequence[Rule] = RULES) -> str:
    """The same result without an index: every rule scans every text."""
    one = []
    for place, r in enumerate(rules):
        p = r.pattern.replace("'", "''")
        one.append(
            f"SELECT rid, {place} AS place, '{r.kind}' AS kind, {r.least} AS least, "
            f"list_transform(regexp_extract_all(text, '{p}'), lambda x: length(x)) AS size, "
            f"list_transform(regexp_extract_all(text, '{p}', {r.group}), lambda x: length(x)) AS own, "
            f"list_transform(string_split_regex(text, '{p}'), lambda x: length(x)) AS gap "
            f"FROM d WHERE regexp_matches(text, '{p}')")
    joined = lambda cond: f"coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, place){cond}, '')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
m AS ({' UNION ALL '.join(one)}),
u AS (SELECT rid, place, kind, least, unnest(range(1, len(size) + 1)) AS i, unnest(size) AS size, unnest(own) AS own,
             unnest(gap[1:len(size)]) AS gap FROM m),
c AS (SELECT rid, place, kind, least, own, size, sum(gap + size) OVER (PARTITION BY rid, place ORDER BY i) AS e FROM u),
f AS (SELECT rid, place, kind, (e - size)::BIGINT AS s, e::BIGINT AS e FROM c WHERE own >= least),
a AS (SELECT rid, {', '.join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in BASE)},
             {joined(f' FILTER (place < {len(BASE)})')} AS base, {joined('')} AS spans FROM f GROUP BY rid)
SELECT doc_id, {', '.join(f'coalesce(n_{r.kind}, 0) AS n_{r.kind}' for r in BASE)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (rid)"""
