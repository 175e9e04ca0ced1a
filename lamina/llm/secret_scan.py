"""Secret scans over a trigram inverted index, in DataFrame functions only.

Each rule is a regular expression. Its parse tree gives a Boolean query over trigrams
that every match must contain (lower case). The index holds a posting (trigram,
document) for each of the rules' trigrams that a document contains; intersecting
postings gives each rule's candidates, and only these are searched with the rule's
expression. Rules without a mandatory trigram scan every document.

Postings of a document come from one row, so they are combined before they are
shuffled, and a common trigram never becomes one list or one task.

Spans are [start, end) in code points, leftmost and without overlap within a rule.
They are found from the lengths of the matches and of the texts between them; prefix
sums go by blocks, so a text with very many matches stays cheap. To take secrets out, spans are
found in bytes, and what lies between them is cut out and joined once.

A private key's span goes from its BEGIN line over its body to its END line; without an
END line it ends with the last piece of base64 that follows the header.

Results for special cases: a null text is empty and has no spans. Repeated rows get
equal results, each its own row. Whole texts are searched. Documents are told apart by
id and text, so null or repeated ids do no harm; further columns have no influence. An
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from itertools import product
from re import _constants as sre
from re import _parser as sre_parse

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``least``: characters that ``group`` of a match must have, else it is dropped.
    ``same_as``: an expression with the same results once short matches are dropped,
    cheaper to search."""

    name: str
    pattern: str
    group: int = 0
    least: int = 0
    ignore_case: bool = False
    same_as: str | None = None


#: The base rules.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, ignore_case=True),
    # a match is a whole run (or all of it from its first AKIA on), so the least length may stand in it
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16, same_as=r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]+", 0, 32, same_as=r"[0-9a-f]{32,}"),
)

_PEM = r"[A-Z\x20]{0,24}PRIVATE\x20KEY-----"
#: What may stand between the pieces of a key: blanks, line breaks, also as escapes, and
#: the quotes, plus signs and marks of code, comments and quoted mail.
_GAP = r"""(?:[\x20\t\r\n"'+,;>#*|.]|\\+[nrt]?)*+"""
_BASE64 = r"(?:[A-Za-z0-9+/]|\\/)"
_PAD = r"(?:=|\\u003d){0,2}+"
#: Pieces of a key's body: its header fields; long runs of base64; lines of base64 only,
#: however short; a last short run before the END line. Possessive, so that Java takes
#: bodies of any length without recursion. Text with other words ends the body.
_BODY = "|".join((
    rf"{_GAP}(?:Proc-Type:\x20*+[0-9],[A-Z-]++|DEK-Info:\x20*+[A-Z0-9-]++(?:,[0-9A-Fa-f]++)?+)",
    rf"{_GAP}{_BASE64}{{20,}}+{_PAD}",
    rf"""["'\x20\t]*+(?:[\r\n]|\\+[rn]){_GAP}{_BASE64}++{_PAD}(?=["'\x20\t+,;]*+(?![^\r\n\\]))""",
    rf"{_GAP}{_BASE64}++{_PAD}(?={_GAP}-----END\x20{_PEM})",
))

#: Well-known forms of tokens and keys.
MORE = (
    Rule("github", r"gh[opusr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    # the header, the body as far as it goes, and the END line if it follows
    Rule("private_key", rf"-----BEGIN\x20{_PEM}(?:{_BODY})*+(?:{_GAP}-----END\x20{_PEM})?+"),
)

RULES = BASE + MORE

#: A query is True, or a set of alternatives, each a set of trigrams.
Query = bool | frozenset[frozenset[str]]


def _and(a: Query, b: Query) -> Query:
    if a is True or b is True:
        return b if a is True else a
    return _least({x | y for x in a for y in b})


def _least(alternatives: set[frozenset[str]]) -> Query:
    kept = [a for a in alternatives if not any(b < a for b in alternatives)]
    return True if frozenset() in kept else frozenset(kept)


def _of_strings(strings: set[str]) -> Query:
    return _least({frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings})


_MOST_STRINGS = 64


def _strings(op, arg) -> set[str] | None:
    """All strings of a part of an expression, lower case, if these are few."""
    if op is sre.LITERAL:
        return {chr(arg).lower()}
    if op is sre.IN:
        out: set[str] = set()
        for kind, x in arg:
            if kind is sre.LITERAL:
                out.add(chr(x).lower())
            elif kind is sre.RANGE and x[1] - x[0] < 8:
                out |= {chr(c).lower() for c in range(x[0], x[1] + 1)}
            else:
                return None
        return out
    if op is sre.SUBPATTERN:
        return _all([_strings(*x) for x in arg[3]])
    if op is sre.BRANCH:
        parts = [_all([_strings(*x) for x in b]) for b in arg[1]]
        return None if None in parts else set().union(*parts)
    if op is sre.MAX_REPEAT and arg[1] <= 4:
        body = _all([_strings(*x) for x in arg[2]])
        parts = [_all([body] * n) for n in range(arg[0], arg[1] + 1)]
        return None if None in parts else set().union(*parts)
    return None


def _all(parts: list[set[str] | None]) -> set[str] | None:
    out = {""}
    for p in parts:
        if p is None or len(out) * len(p) > _MOST_STRINGS:
            return None
        out = {a + b for a, b in product(out, p)}
    return out


def trigram_query(pattern: str) -> Query:
    """The trigrams (lower case) that every match of an expression contains."""

    def of(parts) -> Query:
        query: Query = True
        run = {""}
        for op, arg in parts:
            strings = _strings(op, arg)
            joined = None if strings is None else _all([run, strings])
            if joined is not None:
                run = joined
                continue
            query = _and(query, _of_strings(run))
            run = strings if strings is not None else {""}
            if strings is None:
                if op is sre.SUBPATTERN:
                    query = _and(query, of(arg[3]))
                elif op is sre.MAX_REPEAT and arg[0] > 0:
                    query = _and(query, of(arg[2]))
                elif op is sre.BRANCH:
                    branches = [of(b) for b in arg[1]]
                    if True not in branches:
                        query = _and(query, _least(set().union(*branches)))
        return _and(query, _of_strings(run))

    return of(sre_parse.parse(pattern))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.md5(text.cast("binary")).alias("h"))


def trigrams_of(rules: tuple[Rule, ...]) -> list[str]:
    queries = [trigram_query(r.pattern) for r in rules]
    return sorted(set().union(*(a for q in queries if q is not True for a in q)))


def postings(keyed: DataFrame, trigrams: list[str]) -> DataFrame:
    """The index: (trigram number, doc_id, h), a row for each trigram of a document."""
    low = keyed.select("doc_id", "h", F.lower("text").alias("low"))
    found = F.array_compact(F.array(*(F.when(F.col("low").contains(t), F.lit(i)) for i, t in enumerate(trigrams))))
    return low.select("doc_id", "h", F.explode(found).alias("trigram"))


def candidates(index: DataFrame, rules: tuple[Rule, ...], trigrams: list[str]) -> DataFrame:
    """(doc_id, h, rules): documents whose postings satisfy a rule's query; bit i of
    ``rules`` stands for rule i."""
    place = {t: i for i, t in enumerate(trigrams)}
    words = -(-max(len(trigrams), 1) // 60)
    mask = lambda w: F.bit_or(F.when(F.floor(F.col("trigram") / 60) == w, F.expr("shiftleft(1L, trigram % 60)")).otherwise(F.lit(0).cast("long")))
    held = index.groupBy("doc_id", "h").agg(*(mask(w).alias(f"m{w}") for w in range(words)))

    def has(alternative: frozenset[str]) -> Column:
        out = F.lit(True)
        for w in range(words):
            bits = sum(1 << place[t] % 60 for t in alternative if place[t] // 60 == w)
            if bits:
                out &= F.col(f"m{w}").bitwiseAND(F.lit(bits)) == bits
        return out

    found = F.lit(0)
    for i, r in enumerate(rules):
        query = trigram_query(r.pattern)
        if query is not True:
            hit = F.lit(False)
            for a in sorted(query, key=sorted):
                hit |= has(a)
            found = found + F.when(hit, F.lit(1 << i)).otherwise(F.lit(0))
    return held.select("doc_id", "h", found.alias("rules")).where("rules > 0")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


_BLOCK = 64
_SPANS = "array<struct<start:bigint,kind:int,end:bigint>>"


def _folded(op: Callable[[Column, Column], Column]) -> Callable[[Column], Column]:
    return lambda x: F.aggregate(x, F.lit(0).cast("long"), op)


_ADD = lambda a, b: a + b
_MOST = lambda a, b: F.greatest(a, b)


def _running(x: Column, op: Callable[[Column, Column], Column] = _ADD) -> Column:
    """Running sums of an array of numbers from 0 up (or another operation's)."""
    total = _folded(op)
    cut = lambda a: F.transform(F.sequence(F.lit(0), F.floor((F.size(a) - 1) / _BLOCK).cast("int")), lambda b: F.slice(a, (b * _BLOCK + 1).cast("int"), _BLOCK))
    inner = lambda block: F.transform(block, lambda _, k: total(F.slice(block, F.lit(1), k + 1)))
    return _let(x, lambda a: _let(
        F.transform(cut(a), inner),
        lambda blocks: _let(
            F.transform(blocks, lambda b: F.element_at(b, -1)),
            lambda ends: F.flatten(F.zip_with(blocks, F.transform(ends, lambda _, i: total(F.slice(ends, F.lit(1), i))), lambda b, base: F.transform(b, lambda v: op(v, base)))),
        ),
    ))


def rule_spans(text: Column, rule: Rule, kind: int, measure: Callable[[Column], Column] = F.length) -> Column:
    """The spans of a rule in a text: array of (start, kind, end), in code points or what
    else ``measure`` counts."""
    pattern = ("(?i)" if rule.ignore_case else "") + (rule.same_as or rule.pattern)
    length = lambda m: (F.length(m) if rule.group == 0 else F.length(F.regexp_extract(m, pattern, rule.group)))

    def spans(found: Column) -> Column:
        def placed(gaps: Column) -> Column:
            before = lambda m, i: measure(F.get(gaps, i)).cast("long") + F.when(i > 0, measure(F.get(found, i - 1))).otherwise(0)
            all_spans = F.zip_with(_running(F.transform(found, before)), found, lambda s, m: F.struct(s.alias("start"), F.lit(kind).alias("kind"), (s + measure(m)).alias("end"), m.alias("m")))
            good = F.filter(all_spans, lambda s: length(s["m"]) >= rule.least)
            return F.transform(good, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))

        return F.when(F.size(found) == 0, F.array().cast(_SPANS)).otherwise(_let(F.split(text, pattern, -1), placed))

    return _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), spans)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a row of ``docs``: doc_id, text, spans (array of start, kind, end, by
    start and kind; kind is the rule's number)."""
    keyed = _keyed(docs, id_col, text_col)
    trigrams = trigrams_of(rules)
    found = candidates(postings(keyed, trigrams), rules, trigrams).toDF("c_id", "c_h", "rules")
    both = keyed.join(found, F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("h") == F.col("c_h")), "left")
    both = both.select("doc_id", "text", F.coalesce("rules", F.lit(0)).alias("rules"))
    return both.select("doc_id", "text", _all_spans(rules).alias("spans"))


def _all_spans(rules: tuple[Rule, ...], measure: Callable[[Column], Column] = F.length) -> Column:
    each = []
    for i, r in enumerate(rules):
        spans = rule_spans(F.col("text"), r, i, measure)
        if trigram_query(r.pattern) is not True:
            spans = F.when(F.col("rules").bitwiseAND(F.lit(1 << i)) != 0, spans).otherwise(F.array().cast(_SPANS))
        each.append(spans)
    return F.sort_array(F.concat(*each))


def listed(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    names = F.array(*(F.lit(r.name) for r in rules))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each union of overlapping spans replaced by a mark. ``spans`` are in
    bytes: what stays is cut out of the text's bytes, which takes no search for the place, and
    joined once."""

    def kept(raw: Column) -> Column:
        part = lambda a, b: F.substring(raw, (a + 1).cast("int"), (b - a).cast("int")).cast("string")

        def around(reach: Column) -> Column:
            # a span that begins at or after the end of all before begins a union
            before = F.concat(F.array(F.lit(0).cast("long")), reach)
            gaps = F.zip_with(F.slice(before, F.lit(1), F.size(reach)), spans, lambda at, s: F.struct(at.alias("a"), s["start"].alias("b")))
            pieces = F.transform(F.filter(gaps, lambda g: g["b"] >= g["a"]), lambda g: part(g["a"], g["b"]))
            tail = part(F.element_at(reach, -1), F.length(raw))
            return F.array_join(F.concat(pieces, F.array(tail)), mark)

        return _let(_running(F.transform(spans, lambda s: s["end"]), _MOST), around)

    return F.when(F.size(spans) == 0, text).otherwise(_let(text.cast("binary"), kept))


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """The rows of ``docs``, with all their columns, their secrets replaced by a mark.
    ``length_col``, if there is one, is set to the new length where a text changed."""
    columns = docs.columns
    names = {c: f"c{i}" for i, c in enumerate(columns)}
    own = docs.toDF(*names.values())
    text, key = names[text_col], names[id_col]
    keyed = _keyed(own, key, text)
    trigrams = trigrams_of(rules)
    found = candidates(postings(keyed, trigrams), rules, trigrams).toDF("c_id", "c_h", "rules")
    tagged = own.withColumn("h", F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))
    both = tagged.join(found, F.col(key).eqNullSafe(F.col("c_id")) & (F.col("h") == F.col("c_h")), "left")
    both = both.withColumn("rules", F.coalesce("rules", F.lit(0))).withColumn("text", F.coalesce(F.col(text), F.lit("")))
    both = both.withColumn("spans", _all_spans(rules, F.octet_length)).withColumn("changed", F.size("spans") > 0)
    new = F.when(F.col("changed"), redacted(F.col("text"), F.col("spans"))).otherwise(F.col(text))
    out = both.withColumn("new_text", new)
    pick = []
    for c, f in zip(columns, docs.schema, strict=True):
        if c == text_col:
            pick.append(F.col("new_text").alias(c))
        elif c == length_col:
            pick.append(F.when(F.col("changed"), F.length("new_text").cast(f.dataType)).otherwise(F.col(names[c])).alias(c))
        else:
            pick.append(F.col(names[c]).alias(c))
    return out.select(*pick)
