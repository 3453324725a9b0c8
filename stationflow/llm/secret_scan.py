"""Secrets in texts: a trigram index picks the candidates, regular expressions verify them.

From each rule's expression a Boolean query over trigrams is derived: every match must
contain them. The postings of those trigrams (trigram, row key) are built over the
lower-cased texts and intersected by row; only rows that satisfy a rule's query are
searched with its expression. A rule without mandatory trigrams searches every text.

Only DataFrame functions. One pass over a text finds the trigrams that any rule asks for;
postings of others are not built. Postings are shuffled, never a text.
"""

from __future__ import annotations

import itertools
import re
import re._constants as sre
import re._parser as sre_parser
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import checkpointed, packed, unpacked

#: Trigrams of an alternative, clauses of a rule.
MASK_BITS = 62
#: Candidate rows (16 bytes each) that are broadcast; more are joined by shuffle.
BROADCAST_ROWS = 1_000_000
_LARGEST_SET = 64


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds matches left to right; those whose ``group`` is shorter than ``least`` fail."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = True


# The stated kinds, in their stated order.
BASE_RULES = [
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
]
# Published formats of keys.
KEY_RULES = [
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", base=False),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", base=False),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", base=False),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", base=False),
]
RULES = BASE_RULES + KEY_RULES


# --- Boolean trigram queries -------------------------------------------------------
# A query is a frozenset of clauses that must all hold; a clause is a frozenset of
# alternatives; an alternative is a frozenset of trigrams that must all occur.


def _grams(word: str) -> frozenset[str]:
    return frozenset(word[i : i + 3] for i in range(len(word) - 2))


def _clause(words: frozenset[str]) -> frozenset:
    """One of the words occurs; no clause if a word is too short to have a trigram."""
    options = frozenset(_grams(word) for word in words)
    options = frozenset(o for o in options if not any(less < o for less in options))
    return frozenset() if not options or frozenset() in options else frozenset([options])


def _members(items) -> frozenset[str] | None:
    found: set[str] = set()
    for op, value in items:
        if op is sre.LITERAL:
            found.add(chr(value).lower())
        elif op is sre.RANGE and value[1] - value[0] < _LARGEST_SET:
            found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return frozenset(found) if len(found) <= 8 else None


def _analyse(tokens) -> tuple[frozenset[str] | None, frozenset]:
    """All words a sequence can match, if few, and the clauses that hold besides."""
    run, clauses, whole = frozenset([""]), frozenset(), True
    for op, value in tokens:
        words: frozenset[str] | None = None
        inner: frozenset = frozenset()
        if op is sre.LITERAL:
            words = frozenset([chr(value).lower()])
        elif op is sre.IN:
            words = _members(value)
        elif op is sre.SUBPATTERN:
            words, inner = _analyse(value[-1])
        elif op is sre.BRANCH:
            parts = [_analyse(branch) for branch in value[1]]
            if all(part[0] is not None for part in parts):
                words = frozenset().union(*[part[0] for part in parts])
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            low, high, body = value
            once, inside = _analyse(body)
            if once is not None and high != sre.MAXREPEAT and high <= 4:
                words = frozenset("".join(p) for n in range(low, high + 1) for p in itertools.product(once, repeat=n))
            elif low >= 1:
                inner = inside | (_clause(once) if once is not None else frozenset())
        joined = frozenset(a + b for a in run for b in words) if words is not None and len(run) * len(words) <= _LARGEST_SET else None
        if joined is not None:
            run = joined
        else:
            whole = False
            clauses |= _clause(run)
            run = words if words is not None else frozenset([""])
        clauses |= inner
    if whole:
        return run, clauses
    return None, clauses | _clause(run)


def trigram_query(pattern: str) -> frozenset:
    """Clauses every text with a match satisfies once lower-cased; empty: nothing is mandatory."""
    words, clauses = _analyse(sre_parser.parse(pattern))
    return clauses | (_clause(words) if words is not None else frozenset())


# --- index, intersection, verification ----------------------------------------------


def _row_key(id_col: str, text: Column) -> Column:
    return F.xxhash64(F.col(id_col), text)


def _any_of(trigrams: list[str]) -> str:
    """An expression that matches nothing but looks ahead for a trigram, at every place; by first character."""
    quoted = lambda text: re.sub(r"([^A-Za-z0-9])", r"\\\1", text)
    starts: dict[str, list[str]] = {}
    for trigram in trigrams:
        starts.setdefault(trigram[0], []).append(quoted(trigram[1:]))
    return "(?=(" + "|".join(f"{quoted(first)}(?:{'|'.join(rest)})" for first, rest in starts.items()) + "))"


def postings(df: DataFrame, trigrams: list[str], id_col: str, text_col: str) -> DataFrame:
    """(trigram, key): which rows hold which of the trigrams. Each text is read once."""
    low = F.lower(text_col)
    held = F.array_distinct(F.regexp_extract_all(low, F.lit(_any_of(trigrams)), F.lit(1)))
    rows = df.where(F.col(text_col).isNotNull())
    return rows.select(_row_key(id_col, F.col(text_col)).alias("key"), F.explode(held).alias("trigram"))


def _terms(queries: dict[int, frozenset]) -> list[tuple]:
    """(trigram, rule, clause, alternative, bit, all bits, all clauses): who asks for a trigram."""
    rows = []
    for rule, query in queries.items():
        for clause, options in enumerate(sorted(query, key=sorted_text)):
            for option, trigrams in enumerate(sorted(options, key=sorted_text)):
                if max(len(trigrams), len(query)) > MASK_BITS:
                    raise ValueError("a rule asks for too many trigrams at once")
                whole, clauses = (1 << len(trigrams)) - 1, (1 << len(query)) - 1
                rows += [(t, rule, clause, option, 1 << n, whole, clauses) for n, t in enumerate(sorted(trigrams))]
    return rows


def sorted_text(part) -> str:
    """An order for nested sets."""
    return repr(sorted(map(sorted_text, part))) if isinstance(part, frozenset) else part


def candidates(df: DataFrame, rules: list[Rule], id_col: str, text_col: str) -> DataFrame:
    """(key, rules): the rows that satisfy a rule's query, with the numbers of those rules.

    The postings of an alternative's trigrams are intersected by row, those of a clause's
    alternatives united, those of a rule's clauses intersected. Bits say which are there,
    so repeated rows change nothing.
    """
    queries = {n: q for n, rule in enumerate(rules) if (q := trigram_query(rule.pattern))}
    terms = _terms(queries)
    if not terms:
        return df.select(_row_key(id_col, F.col(text_col)).alias("key"), F.array().cast("array<int>").alias("rules")).where(F.lit(False))
    names = ("trigram", "rule", "clause", "option", "bit", "whole", "clauses")
    kinds = ("string", "int", "int", "int", "bigint", "bigint", "bigint")
    rows = [F.struct(*[F.lit(v).cast(k).alias(n) for n, k, v in zip(names, kinds, row, strict=True)]) for row in terms]
    # A row for each trigram of the rules.
    asked = F.broadcast(df.sparkSession.range(1).select(F.inline(F.array(*rows))))
    met = postings(df, sorted({row[0] for row in terms}), id_col, text_col).join(asked, "trigram")
    options = met.groupBy("key", "rule", "clause", "option", "whole", "clauses").agg(F.bit_or("bit").alias("found"))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("clause"))
    held = options.where(F.col("found") == F.col("whole")).groupBy("key", "rule", "clauses").agg(F.bit_or(one).alias("held"))
    fitting = held.where(F.col("held") == F.col("clauses"))
    return fitting.groupBy("key").agg(F.collect_set("rule").alias("rules"))


def _matches(text: Column, rule: Rule, number: int) -> Column:
    """Spans of a rule's matches, in code points: what lies between matches gives the places."""
    hits = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    groups = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else hits
    gaps = F.slice(F.split(text, rule.pattern, -1), F.lit(1), F.size(hits))
    shape = "array<struct<start:bigint,rule:int,end:bigint,kind:string>>"

    def step(seen, hit):
        start = seen["at"] + F.length(hit["gap"])
        end = start + F.length(hit["hit"])
        span = F.array(F.struct(start.alias("start"), F.lit(number).alias("rule"), end.alias("end"), F.lit(rule.kind).alias("kind")))
        good = F.length(hit["group"]) >= rule.least
        return F.struct(end.alias("at"), F.when(good, F.concat(seen["spans"], span)).otherwise(seen["spans"]).alias("spans"))

    zipped = F.arrays_zip(gaps.alias("gap"), hits.alias("hit"), groups.alias("group"))
    none = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(shape).alias("spans"))
    return F.aggregate(zipped, none, step)["spans"]


def scan(
    df: DataFrame, rules: list[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """Add ``found``: spans (start, rule, end, kind) of all secrets in the text, by start, then rule.

    Offsets are code points, ends exclusive. The whole text is searched, however long. A
    null or empty text has none. Null or repeated ids do no harm: rows are told apart by
    id and text together, and rows alike in both have the same secrets. An empty table
    gives an empty one. An input column named ``found`` is replaced.
    """
    kept = [name for name in (df.columns if keep is None else keep) if name != "found"]
    picked = checkpointed(candidates(df, rules, id_col, text_col)).select(F.col("key").alias("_key"), F.col("rules").alias("_rules"))
    if picked.count() <= BROADCAST_ROWS:
        picked = F.broadcast(picked)
    carried = [name for name in kept if name != text_col]
    rows = df.select(packed(carried).alias("_kept"), F.col(text_col).alias("_text"), _row_key(id_col, F.col(text_col)).alias("_key"))
    rows = rows.join(picked, "_key", "left")
    none = F.array().cast("array<struct<start:bigint,rule:int,end:bigint,kind:string>>")
    text = F.col("_text")
    spans = []
    for number, rule in enumerate(rules):
        if trigram_query(rule.pattern):
            wanted = F.array_contains("_rules", F.lit(number))
        else:
            wanted = text.rlike(rule.pattern)
        spans.append(F.when(wanted, _matches(text, rule, number)).otherwise(none))
    mine = {name: column for name, column in zip(carried, unpacked(carried), strict=True)} | {text_col: text.alias(text_col)}
    return rows.select(*[mine[name] for name in kept], F.array_sort(F.flatten(F.array(*spans))).alias("found"))


def written(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
