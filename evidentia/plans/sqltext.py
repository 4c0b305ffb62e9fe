"""Fragments of the checking SQL (DuckDB dialect, RE2 patterns).

Written independently of the column expressions they check: list functions
and plain CASE where the engine uses regular expressions over joined rows,
and the other way round.
"""

from __future__ import annotations

from evidentia import policy as fixed

SPACE = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
LINES = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"


def norm(x: str) -> str:
    return f"trim(regexp_replace(coalesce({x}, ''), '{SPACE}+', ' ', 'g'))"


def fold(x: str) -> str:
    out = f"translate(lower({x}), 'ſς', 'sσ')"
    for letter, expansion in (
        ("ß", "ss"), ("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬃ", "ffi"), ("ﬄ", "ffl"), ("ﬅ", "st"), ("ﬆ", "st"),
    ):
        out = f"replace({out}, '{letter}', '{expansion}')"
    return out


def anchor(x: str) -> str:
    return f"trim(regexp_replace({fold(x)}, '[^a-z0-9]+', ' ', 'g'))"


def mask(x: str) -> str:
    return norm(rf"regexp_replace({fold(x)}, '\p{{Nd}}', '#', 'g')")


def lines(x: str) -> str:
    return f"regexp_split_to_array({x}, '{LINES}')"


def rows(x: str) -> str:
    return f"list_filter(list_transform({lines(x)}, lambda l: {norm('l')}), lambda l: l <> '')"


def label(text: str, row_list: str, pattern: str) -> str:
    joined = f"array_to_string({row_list}, chr(10))"
    below = f"regexp_extract({joined}, '(?im)^{pattern} ?:?\\n([^\\n]+)', 1)"
    beside = norm(f"regexp_extract({text}, '(?i)\\b{pattern}[ \\t]*:?[ \\t]*([^|;\\n]{{1,90}})', 1)")
    return f"case when {below} <> '' then trim({below}, ' .,:;') else trim({beside}, ' .,:;') end"


def name(x: str) -> str:
    labels = sorted({*(v for g in fixed.ANCHOR_LABELS.values() for v in g), *fixed.OTHER_NON_NAMES})
    listed = ", ".join(f"'{v}'" for v in labels)
    words = f"regexp_extract_all({x}, '[A-Za-z][A-Za-z''-]*')"
    first = f"(case when len({words}) >= 3 and lower({words}[1]) = 'is' then {words}[2:] else {words} end)"
    tail = f"lower({first}[-2] || ' ' || {first}[-1])"
    kept = (
        f"(case when len({first}) >= 4 and {tail} in ('passport image', 'scan image') "
        f"then {first}[:-3] else {first} end)"
    )
    shown = f"array_to_string(list_transform({kept}[1:4], lambda w: upper(w[1]) || lower(w[2:])), ' ')"
    return f"case when {anchor(x)} in ({listed}) or len({kept}) < 2 then '' else {shown} end"


def species(x: str) -> str:
    code = f"replace(replace(upper({norm(x)}), ' ', '_'), '-', '_')"
    return f"case when regexp_full_match({code}, '[A-Z][A-Z_]{{1,36}}') then {code} else '' end"


def day(x: str) -> str:
    iso = f"replace(regexp_extract({x}, '\\b20[0-9][0-9][-/][0-9][0-9][-/][0-9][0-9]\\b'), '/', '-')"
    return f"case when try_cast({iso} as date) is not null then {iso} else '' end"


def sponsor(x: str) -> str:
    digits = f"regexp_extract(upper({x}), '\\bSPN[- ]?([0-9]{{4}})\\b', 1)"
    return f"case when {digits} <> '' then 'SPN-' || {digits} else '' end"


def flags(x: str) -> str:
    folded = f"replace(replace({fold(x)}, '-', '_'), ' ', '_')"
    every = sorted(fixed.DISQUALIFYING_FLAGS + fixed.REVIEW_FLAGS)
    found = "concat_ws('|', " + ", ".join(
        f"case when contains({folded}, '{f}') then '{f}' end" for f in every
    ) + ")"
    return (
        f"case when {found} <> '' then {found} "
        f"when regexp_matches({x}, '(?i)\\bnone\\b|\\bclear\\b') then 'none' else '' end"
    )


def fee_word(x: str) -> str:
    return f"lower(regexp_extract({x}, '(?i)\\b(unpaid|paid|waived)\\b', 1))"


def anchored_fee(x: str) -> str:
    return (
        f"case when not (contains({anchor(x)}, 'fee receipt') or contains({anchor(x)}, 'fee status')) then '' "
        f"when {fee_word(x)} <> '' then {fee_word(x)} "
        f"when regexp_matches({x}, '\\$\\s*809(?:\\.00)?(?:\\s|$)') then 'paid' else '' end"
    )


def visa(x: str) -> str:
    return f"replace(upper(regexp_extract({x}, '(?i)\\b({fixed.VISA_PATTERN})\\b', 1)), ' ', '-')"


def finding(x: str, prefix: str = "") -> str:
    raw = f"regexp_extract({x}, '(?i)\\b{prefix}({fixed.FINDING_PATTERN})\\b', 1)"
    return f"replace(replace(upper({raw}), ' ', '_'), '-', '_')"


def kind(x: str) -> str:
    folded = fold(x)
    scores = {
        k: "(" + " + ".join(f"contains({folded}, '{m}')::int" for m in markers) + ")"
        for k, markers in fixed.PAGE_MARKERS.items()
    }
    best = f"greatest({', '.join(scores.values())})"
    arms = " ".join(f"when {s} = {best} then '{k}'" for k, s in scores.items())
    top = f"(case {arms} end)"
    return (
        f"case when {best} >= 2 or ({best} = 1 and {top} in ('biometric', 'note')) then {top} else 'other' end"
    )


def weight(k: str) -> str:
    return f"case {k} " + " ".join(f"when '{n}' then {w}" for n, w in fixed.PRECEDENCE.items()) + " end"


def above(row_list: str, pattern: str, validate) -> str:
    """First accepted row among the four rows above a label row."""
    spots = (
        f"list_filter(range(1, len({row_list}) + 1), lambda i: "
        f"regexp_full_match({row_list}[i], '(?i){pattern} ?:?'))"
    )
    candidates = (
        f"flatten(list_transform({spots}, lambda i: list_transform(range(1, 5), "
        f"lambda d: case when i - d >= 1 then {validate(f'{row_list}[i - d]')} else '' end)))"
    )
    return f"coalesce(list_filter({candidates}, lambda v: v <> '')[1], '')"


#: Evidence of every reading, label readers only, without near-miss recovery.
def evidence(source: str = "readings") -> str:
    def lab(pattern: str) -> str:
        return label("text", "rws", pattern)

    labels = {
        "l_name": "Applicant Name", "l_applicant": "Applicant", "l_registry": "Registry Name",
        "l_species": "Species(?: Code)?", "l_world": "Home World", "l_sponsor_id": "Sponsor ID",
        "l_sponsor": "Sponsor", "l_date": "Arrival Date", "l_declared": "Declared Purpose",
        "l_purpose": "Purpose", "l_fee": "Fee Status", "l_observed": "Observed Flags",
        "l_risk": "Risk Flags", "l_flag": "(?:Risk )?Flag", "l_status": "Registry Status",
        "l_finding": "Finding",
    }

    def first(*values: str) -> str:
        return "coalesce(" + ", ".join(f"nullif({v}, '')" for v in values) + ", '')"

    emitted = [
        ("applicant_name", first(name("l_name"), name("l_applicant"), above("rws", "Applicant Name", name), above("rws", "Applicant", name), name("l_registry"))),
        ("species_code", species("l_species")),
        ("home_world", norm("l_world")),
        ("visa_class", visa("text")),
        ("sponsor_id", first(sponsor("l_sponsor_id"), sponsor("l_sponsor"), above("rws", "Sponsor ID", sponsor), above("rws", "Sponsor", sponsor), f"case when kind = 'sponsor' then {sponsor('text')} else '' end")),
        ("arrival_date", day("l_date")),
        ("declared_purpose", first(norm("l_declared"), norm("l_purpose"))),
        ("fee_status", fee_word("l_fee")),
        ("risk_flags", flags(first("l_observed", "l_risk"))),
        ("registry_embargo_review", "case when kind = 'registry' and regexp_matches(l_status, '(?i)\\bembargo\\b') then 'true' else '' end"),
        ("risk_flags", f"case when kind = 'note' then {flags(first('l_flag', 'text'))} else '' end"),
    ]
    arms = " union all ".join(
        f"select case_id, channel, page, reading_no, {i} as ordinal, '{field}' as field, {value} as value, "
        f"kind as source, {weight('kind')} as weight from labelled"
        for i, (field, value) in enumerate(emitted)
    )
    return (
        f"rowed as (select *, {rows('text')} as rws, {kind('text')} as kind from {source}), "
        f"labelled as materialized (select *, {', '.join(f'{lab(p)} as {n}' for n, p in labels.items())} from rowed), "
        f"evidence as materialized (select * from ({arms}) where value <> '')"
    )


def ratio(source: str) -> str:
    """Named queries ending in ``scored(a, b, score)``: the matching-blocks
    similarity of every (a, b) of ``source``, by explicit recursion over the
    longest common blocks."""
    run = (
        "len(list_filter(range(1, least(ahi - i, bhi - j) + 1), lambda n: substring(a, i, n) = substring(b, j, n)))"
    )
    block = (
        "list_max(flatten(list_transform(range(alo, ahi), lambda i: list_transform(range(blo, bhi), "
        f"lambda j: {{'k': {run}, 'i': -i, 'j': -j}}))))"
    )
    return (
        f"st as (select a, b, alo, ahi, blo, bhi, {block} as m from (select distinct a, b, 1 as alo, length(a)::int + 1 as ahi, 1 as blo, length(b)::int + 1 as bhi from {source}) "
        f"union all select a, b, alo, ahi, blo, bhi, {block} as m from (select a, b, w.alo, w.ahi, w.blo, w.bhi from "
        "(select a, b, unnest([{'alo': alo, 'ahi': (-m.i)::int, 'blo': blo, 'bhi': (-m.j)::int}, "
        "{'alo': (m.k - m.i)::int, 'ahi': ahi, 'blo': (m.k - m.j)::int, 'bhi': bhi}]) as w from st where coalesce(m.k, 0) > 0)) "
        "where alo < ahi and blo < bhi), "
        "scored as materialized (select a, b, coalesce(2.0 * sum(coalesce(m.k, 0)) / nullif(length(a) + length(b), 0), 1.0) as score from st group by a, b)"
    )
