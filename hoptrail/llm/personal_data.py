"""Personal data: fixed patterns, and contextual patterns bootstrapped from them.

The fixed patterns find e-mail addresses, IP addresses, payment cards and phone
numbers. These are the seeds, and long mixed strings of letters and digits are seeds
of the kind ``secret``, which are no personal data yet: only a confident pattern
makes them so. Every identifier-like word (one with a digit or an at
sign) is an instance. Its lexical patterns are the two words before it; the word
before and the word after; a label before it (``Badge:``); the word before with the
shape of the instance. One word will do for the first where a text begins
or an identifier stands before it; an identifier is itself the word only where no
other is between, and an address then counts as ``@``. The graph of patterns and instances is scored in
turns: a pattern by the share of its instances that are known to be of its kind, an
instance by its patterns, if several agree. Patterns above ``LEAST_CONFIDENCE`` with enough different
seeds mark the other words they surround as personal data of the same kind.

Everything is built-in functions. Matches and the gaps between them give the places
of the matches. Repetitions are possessive, and a match may only start where a run
of its characters starts or the last match ended, so long runs take linear time.
Patterns and instances are counted with partial aggregation; a word pair that a
third of all documents contain is no hot spot.

Defined cases: null and empty texts have no spans; rows without doc_id and repeated
rows are each searched; spans of different kinds may overlap; contextual spans that
overlap a fixed one are dropped; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoptrail.llm.spool import spool

KINDS = ("email", "ip", "card", "phone")
SECRET = "secret"
SECRET_FORM = "^(?=[^0-9]*[0-9])(?=[^A-Za-z]*[A-Za-z])[A-Za-z0-9_+/-]{24,}$"
MOST_SHAPE = 40
LEAST_CONFIDENCE = 0.8
LEAST_SEEDS = 5
PRIOR = 1.0
ROUNDS = 3

# Fixed patterns. Group repetitions are possessive and starts are limited to where
# a match can start at all, which changes no match.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_HINTS = {"email": "@", "phone": "+"}
_SPACE = r"\x20\x09-\x0D"
# Of a gap between identifiers, the characters next to one that are looked at; a word
# longer than that is cut in a pattern.
BEFORE, AFTER = 100, 60
_BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
IDENTIFIER = rf"(?<![^{_SPACE}])[^{_SPACE}0-9@]*+[0-9@][^{_SPACE}]*+"


def _literal(pattern: str) -> str:
    return "r'" + pattern.replace("'", "\\'") + "'"


def _places(matches: str, gaps: str, extra: str = "") -> str:
    """SQL for the places of the matches of a pattern from the texts around them."""
    fields = "start:int,end:int,text:string" + ",before:string,after:string" * bool(extra)
    return f"""aggregate(
        sequence(1, size({matches})),
        named_struct('at', 0, 'found', cast(array() as array<struct<{fields}>>)),
        (s, i) -> named_struct(
            'at', s.at + length({gaps}[i - 1]) + length({matches}[i - 1]),
            'found', concat(s.found, array(named_struct(
                'start', s.at + length({gaps}[i - 1]),
                'end', s.at + length({gaps}[i - 1]) + length({matches}[i - 1]),
                'text', {matches}[i - 1]{extra})))),
        s -> s.found)"""


_DIGITS = "regexp_replace(m.text, '[^0-9]', '')"
_LUHN = f"""aggregate(sequence(1, length({_DIGITS})), 0, (total, i) -> total + case
    when i % 2 = 1 then cast(substring({_DIGITS}, -i, 1) as int)
    when substring({_DIGITS}, -i, 1) >= '5' then 2 * cast(substring({_DIGITS}, -i, 1) as int) - 9
    else 2 * cast(substring({_DIGITS}, -i, 1) as int) end) % 10 = 0"""
_VALID = {
    "email": "true",
    "ip": r"forall(split(m.text, '\\.'), part -> coalesce(try_cast(part as bigint) <= 255, false))",
    "card": f"length({_DIGITS}) between 13 and 19 and {_LUHN}",
    "phone": f"length({_DIGITS}) between 9 and 15",
}


def fixed_spans(docs: DataFrame) -> DataFrame:
    """Adds ``_email`` ... ``_phone``, arrays of valid matches, and ``_words``, the
    identifier-like words with their neighbours, for the column ``_t``."""
    found = docs
    for kind, pattern in {**PATTERNS, "words": IDENTIFIER}.items():
        hint = f"contains(_t, '{_HINTS[kind]}')" if kind in _HINTS else "_t rlike '[0-9@]'"
        found = found.selectExpr(
            "*",
            f"if({hint}, regexp_extract_all(_t, {_literal(pattern)}, 0), array()) as _m_{kind}",
            f"if({hint}, split(_t, {_literal(pattern)}, -1), array()) as _g_{kind}",
        )
    # Of the gap before, up to two words; with none in it, the identifier before it
    # and the word before that. Of the gap after, one word or else the identifier.
    last_two, last = rf"(?:[^{_SPACE}]+[{_SPACE}]+)?[^{_SPACE}]+$", rf"[^{_SPACE}]+$"
    ends = {
        side: f"lower({cut}(trim({side} {_literal(_BLANKS)} from %s), {n}))"
        for side, cut, n in (("trailing", "right", BEFORE), ("leading", "left", AFTER))
    }
    other = "if(contains(get(_m_words, %s), '@'), '@', lower(%s(get(_m_words, %s), %s)))"
    context = f""", 'before', if(trim(both {_literal(_BLANKS)} from _g_words[i - 1]) <> '',
            regexp_extract({ends["trailing"] % "_g_words[i - 1]"}, {_literal(last_two)}, 0),
            if(i = 1, '', concat(
                regexp_extract({ends["trailing"] % "get(_g_words, i - 2)"}, {_literal(last)}, 0), ' ',
                {other % ("i - 2", "right", "i - 2", BEFORE)}))),
        'after', if(trim(both {_literal(_BLANKS)} from _g_words[i]) <> '',
            regexp_extract({ends["leading"] % "_g_words[i]"}, {_literal(rf"^[^{_SPACE}]+")}, 0),
            if(i = size(_m_words), '', {other % ("i", "left", "i", AFTER)}))"""
    places = {k: _places(f"_m_{k}", f"_g_{k}", context if k == "words" else "") for k in (*KINDS, "words")}
    empty = "cast(array() as array<struct<start:int,end:int,text:string>>)"
    found = found.selectExpr(
        "*",
        *(f"if(size(_m_{k}) = 0, {empty}, {places[k]}) as _p_{k}" for k in KINDS),
        f"""if(size(_m_words) = 0,
            cast(array() as array<struct<start:int,end:int,text:string,before:string,after:string>>),
            {places["words"]}) as _words""",
    )
    valid = [
        f"transform(filter(_p_{k}, m -> {_VALID[k]}), m -> named_struct('start', m.start, 'end', m.end)) as _{k}"
        for k in KINDS
    ]
    scratch = [f"_{x}_{k}" for x in "mg" for k in (*KINDS, "words")] + [f"_p_{k}" for k in KINDS]
    return found.selectExpr("*", *valid).drop(*scratch)


def occurrences(found: DataFrame) -> DataFrame:
    """One row per identifier-like word and lexical pattern around it. ``seed`` is
    the kind of the fixed span that the word overlaps."""
    seed = "case " + " ".join(
        f"when exists(_{k}, s -> s.start < w.end and w.start < s.end) then '{k}'" for k in KINDS
    ) + " end"
    lead = "length(regexp_extract(w.text, '^[^A-Za-z0-9]*', 0))"
    core = "regexp_replace(w.text, '^[^A-Za-z0-9]+|(?<![^A-Za-z0-9])[^A-Za-z0-9]+$', '')"
    one = rf"regexp_extract(w.before, {_literal(rf'[^{_SPACE}]+$')}, 0)"
    shape = "regexp_replace(regexp_replace(instance, '[0-9]', '9'), '[A-Za-z]', 'a')"
    rows = (
        found.selectExpr("_row", *(f"_{k}" for k in KINDS), "explode(_words) as w")
        .selectExpr("*", f"{core} as instance", f"{one} as last")
        .selectExpr(
            "_row",
            f"coalesce({seed}, if(instance rlike {_literal(SECRET_FORM)}, '{SECRET}', null)) as seed",
            "instance",
            f"w.start + {lead} as start",
            f"""filter(array(
                if(w.before = '', null, concat('before ', regexp_replace(trim(w.before), {_literal(f"[{_SPACE}]+")}, ' '))),
                if(last = '' or w.after = '', null, concat('around ', last, ' ', w.after)),
                if(last rlike '[^:=#].*[:=#]$', concat('label ', last), null),
                if(last = '' or length(instance) > {MOST_SHAPE}, null, concat('shape ', last, ' ', {shape}))),
                p -> p is not null) as patterns""",
        )
    )
    return rows.where("length(instance) >= 4").selectExpr(
        "_row", "seed", "instance", "start", "start + length(instance) as end", "explode(patterns) as pattern"
    )


def confident_patterns(rows: DataFrame) -> DataFrame:
    """``pattern``, ``kind`` and ``confidence`` of the patterns worth following."""
    edges = rows.groupBy("pattern", "instance").agg(F.max("seed").alias("seed"))
    kinds = (
        edges.where("seed is not null")
        .groupBy("pattern", "seed")
        .agg(F.count("*").alias("seeds"))
        .groupBy("pattern")
        .agg(F.max(F.struct("seeds", "seed")).alias("main"))
        .where(f"main.seeds >= {LEAST_SEEDS}")
        .selectExpr("pattern", "main.seed as kind")
    )
    edges = spool(edges.join(kinds, "pattern").select("pattern", "kind", "instance", "seed"))
    known = edges.selectExpr("instance", "kind", "if(seed = kind, 1.0D, 0.0D) as belief").groupBy(
        "instance", "kind"
    ).agg(F.max("belief").alias("belief"))
    scored = None
    for _ in range(ROUNDS):
        scored = spool(
            edges.join(known, ["instance", "kind"])
            .groupBy("pattern", "kind")
            .agg((F.sum("belief") / (F.count("*") + F.lit(PRIOR))).alias("confidence"))
        )
        known = (
            edges.join(scored.where(f"confidence >= {LEAST_CONFIDENCE}"), ["pattern", "kind"], "left")
            .groupBy("instance", "kind")
            .agg(
                F.when(F.max(F.col("seed") == F.col("kind")), 1.0)
                .when(F.count("confidence") >= 2, 1.0 - F.exp(F.sum(F.log1p(-F.least("confidence", F.lit(0.999))))))
                .otherwise(0.0)
                .alias("belief")
            )
        )
    return scored.where(f"confidence >= {LEAST_CONFIDENCE}")


def _listed(spans: str) -> str:
    return f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"


def find_personal_data(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of every document with ``base`` and ``spans``, arrays of
    (kind, start, end) in code points, ordered by kind as listed and then by start."""
    rows = docs.select(
        *keep, F.coalesce("text", F.lit("")).alias("_t"), F.monotonically_increasing_id().alias("_row")
    )
    found = spool(fixed_spans(rows).drop("_t"))
    seen = spool(occurrences(found))
    patterns = confident_patterns(seen)
    more = (
        seen.where(f"seed is null or seed = '{SECRET}'")
        .join(patterns.select("pattern", "kind"), "pattern")
        .groupBy("_row", "start", "end")
        .agg(F.min("kind").alias("kind"))
        .groupBy("_row")
        .agg(F.collect_list(F.struct("kind", "start", "end")).alias("_more"))
    )
    order = f"cast(array_position(array({', '.join(repr(k) for k in (*KINDS, SECRET))}), %s.kind) as int)"
    ordered = (
        "array_sort(%s, (x, y) -> case "
        f"when {order % 'x'} <> {order % 'y'} then {order % 'x'} - {order % 'y'} "
        "else (x.start - y.start) end)"
    )
    base = "concat(" + ", ".join(
        f"transform(_{k}, s -> named_struct('kind', '{k}', 'start', s.start, 'end', s.end))" for k in KINDS
    ) + ")"
    own = [f"`{c}`" for c in keep]
    return (
        found.join(more, "_row", "left")
        .selectExpr(*own, f"{base} as base", "_more")
        .selectExpr(
            *own,
            "base",
            f"if(_more is null, base, {ordered % 'concat(base, _more)'}) as spans",
        )
    )


def span_columns(found: DataFrame) -> DataFrame:
    """Counts and digests of the spans of each document; ``n_context`` counts those
    that the patterns add."""
    counts = [f"cast(size(filter(base, s -> s.kind = '{k}')) as bigint) as n_{k}" for k in KINDS]
    return found.selectExpr(
        "doc_id",
        *counts,
        f"sha2({_listed('base')}, 256) as base_sha256",
        f"{_listed('spans')} as spans",
        "cast(size(spans) - size(base) as bigint) as n_context",
    )


def redacted_text(text: str = "text", spans: str = "spans") -> Column:
    """The text with every span replaced by its kind; of overlapping spans the one
    that starts first names the whole stretch."""
    return F.expr(f"""if(coalesce(size({spans}), 0) = 0, {text}, aggregate(
        array_sort({spans}, (x, y) -> case when x.start <> y.start then x.start - y.start else y.end - x.end end),
        named_struct('at', 0, 'out', cast('' as string)),
        (s, x) -> if(x.start < s.at,
            named_struct('at', greatest(s.at, x.end), 'out', s.out),
            named_struct('at', x.end, 'out', concat(
                s.out, substring({text}, s.at + 1, x.start - s.at), '[', upper(x.kind), ']'))),
        s -> concat(s.out, substring({text}, s.at + 1))))""")
