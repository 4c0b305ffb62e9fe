"""Field validators: text column in, canonical value or '' out."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from evidentia import policy as fixed
from evidentia.functions import similarity
from evidentia.functions.text import (
    anchor_text,
    casefold,
    category_key,
    normalize_space,
    raw_lines,
    rows_text,
    word,
)
from evidentia.policy import DEFAULT, Policy



def _first_group(c: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract(c, pattern, group)


def non_name_labels() -> tuple[str, ...]:
    labels = [label for group in fixed.ANCHOR_LABELS.values() for label in group]
    return tuple(sorted({*labels, *fixed.OTHER_NON_NAMES}))


def name_words(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit("[A-Za-z][A-Za-z'-]*"), F.lit(0))


def clean_name(c: Column) -> Column:
    """Up to four capitalised words; '' for label words and single words.

    Written over the joined words, so that the input is referenced once.
    """
    joined = F.array_join(name_words(c), " ")
    tails = "|".join(fixed.NAME_TAILS)
    joined = F.regexp_replace(joined, r"(?i)\Ais (?=\S+ \S)", "")
    joined = F.regexp_replace(joined, rf"(?i)\A(\S+ \S.*) (?:{tails})\z", "$1")
    name = F.initcap(F.regexp_extract(joined, r"\A\S+(?: \S+){1,3}", 0))
    return F.when(anchor_text(c).isin(*non_name_labels()), F.lit("")).otherwise(name)


def clean_species(c: Column) -> Column:
    code = F.translate(F.upper(normalize_space(c)), " -", "__")
    return F.when(code.rlike(r"\A[A-Z][A-Z_]{1,36}\z"), code).otherwise(F.lit(""))


def is_calendar_date(c: Column) -> Column:
    return F.try_to_date(c, "yyyy-MM-dd").isNotNull()


def clean_date(c: Column) -> Column:
    """The first date-shaped text, if it names a day of the calendar."""
    iso = F.replace(
        _first_group(c, r"(?=2)(?U)\b(20\d{2}[-/]\d{2}[-/]\d{2})\b"), F.lit("/"), F.lit("-")
    )
    return F.when((iso != "") & is_calendar_date(iso), iso).otherwise(F.lit(""))


def clean_sponsor(c: Column) -> Column:
    digits = _first_group(F.upper(c), r"(?=S)(?U)\bSPN[- ]?(\d{4})\b")
    return F.when(digits != "", F.concat(F.lit("SPN-"), digits)).otherwise(F.lit(""))


def repaired_sponsors(c: Column) -> Column:
    """All sponsor ids of a text with look-alike letters read as digits."""
    raw = F.regexp_extract_all(
        F.upper(c), F.lit(rf"(?=S)(?U)\bSPN[- ]?([0-9{fixed.GLYPHS_READ}]{{4}})\b"), F.lit(1)
    )
    return F.transform(
        raw,
        lambda r: F.concat(F.lit("SPN-"), F.translate(r, fixed.GLYPHS_READ, fixed.GLYPHS_MEANT)),
    )


def underscored(c: Column) -> Column:
    spaced = F.replace(casefold(c), F.lit(" "), F.lit("_"))
    return F.replace(spaced, F.lit("-"), F.lit("_"))


def contained_flags(folded: Column, policy: Policy = DEFAULT) -> Column:
    """Flags contained in an ``underscored`` text, sorted and joined by '|'.

    The look-ahead finds overlapping flags as well.
    """
    every = F.regexp_extract_all(folded, F.lit(f"(?=({'|'.join(policy.flags)}))"), F.lit(1))
    return F.array_join(F.array_sort(F.array_distinct(every)), "|")


def flag_mask(folded: Column, policy: Policy = DEFAULT) -> Column:
    """Contained flags as a bit set, so that packets can be folded with bit_or."""
    mask = F.lit(0)
    for bit, flag in enumerate(policy.flags):
        mask = mask + F.when(F.contains(folded, F.lit(flag)), F.lit(1 << bit)).otherwise(F.lit(0))
    return mask


def flags_of_mask(mask: Column, policy: Policy = DEFAULT) -> Column:
    return F.concat_ws(
        "|",
        *[
            F.when(mask.bitwiseAND(F.lit(1 << bit)) != 0, F.lit(flag))
            for bit, flag in enumerate(policy.flags)
        ],
    )


def exact_flags(c: Column, policy: Policy = DEFAULT) -> Column:
    """Contained flags, else 'none' for an explicit none/clear, else ''."""
    found = F.nullif(contained_flags(underscored(c), policy), F.lit(""))
    clear = F.when(c.rlike(word("nc", r"(?:none|clear)\b")), F.lit("none"))
    return F.coalesce(found, clear, F.lit(""))


def flag_tokens(c: Column) -> Column:
    """Tokens eligible for flag recovery; NULL when the text is not field-like."""
    tokens = F.regexp_extract_all(
        F.replace(casefold(c), F.lit("-"), F.lit("_")), F.lit(r"[a-z][a-z0-9_]{5,40}"), F.lit(0)
    )
    short = F.size(tokens).between(1, 3) & (F.length(normalize_space(c)) <= 80)
    return F.when(short, tokens)


def recovered_flags(matches: Column, policy: Policy = DEFAULT) -> Column:
    accept = policy.fuzzy_flag
    good = F.filter(
        matches,
        lambda m: (m["score"] >= accept.score) & (m["score"] - m["runner_up"] >= accept.margin),
    )
    return F.array_join(F.array_sort(F.array_distinct(F.transform(good, lambda m: m["value"]))), "|")


def clean_flags(c: Column, policy: Policy = DEFAULT) -> Column:
    """Exact flags, else near-misses of a short field-like text."""
    exact = exact_flags(c, policy)
    match = similarity.nearest_each({f: f for f in policy.flags}, policy.fuzzy_flag.floor)
    near = match(F.when(exact == "", flag_tokens(c)))
    return F.when(exact != "", exact).otherwise(F.coalesce(recovered_flags(near, policy), F.lit("")))


def fee_anchored(c: Column) -> Column:
    folded = anchor_text(c)
    return F.contains(folded, F.lit("fee receipt")) | F.contains(folded, F.lit("fee status"))


def exact_fee(c: Column) -> Column:
    return F.lower(_first_group(c, word("".join({s[0]: s for s in fixed.FEE_STATES}), rf"({'|'.join(fixed.FEE_STATES)})\b")))


def damaged_fee(c: Column) -> Column:
    """The word printed after the fee label; NULL when absent or 'unknown'."""
    said = F.lower(_first_group(c, word("f", r"fee status\s*[:.=-]?\s*([a-z]{3,12})")))
    return F.when((said != "") & (said != "unknown"), said)


def paid_amount(c: Column) -> Column:
    return F.when(c.rlike(fixed.PAID_AMOUNT), F.lit("paid")).otherwise(F.lit(""))


def anchored_fee(c: Column, policy: Policy = DEFAULT, fuzzy: bool = True) -> Column:
    """Fee state of a text that carries a fee label.

    An exact word, else (``fuzzy``) a near-miss of the labelled word, else the
    standard amount. A zero amount proves nothing.
    """
    exact = exact_fee(c)
    tail = paid_amount(c)
    if fuzzy:
        accept = policy.fuzzy_fee
        match = similarity.nearest({s: s for s in fixed.FEE_STATES}, accept.floor)
        near = match(F.when(fee_anchored(c) & (exact == ""), damaged_fee(c)))
        good = (near["score"] >= accept.score) & (near["score"] - near["runner_up"] >= accept.margin)
        tail = F.when(good, near["value"]).otherwise(tail)
    return F.when(~fee_anchored(c), F.lit("")).when(exact != "", exact).otherwise(tail)


def visa_token(raw: Column) -> Column:
    return F.translate(F.upper(raw), " ", "-")


def find_visa(c: Column) -> Column:
    return visa_token(_first_group(c, word("xdmt", rf"({fixed.VISA_PATTERN})\b")))


def output_visa(c: Column) -> Column:
    """Insert the hyphen a visa class was read without."""
    return F.regexp_replace(c, r"\A(XW|DIP|MED|TRANSIT)-?([1237])\z", "$1-$2")


def finding_token(raw: Column) -> Column:
    return F.translate(F.upper(raw), " -", "__")


def find_finding(c: Column) -> Column:
    return finding_token(_first_group(c, word("adn", rf"({fixed.FINDING_PATTERN})\b")))


def exact_enum(c: Column, choices: tuple[str, ...]) -> Column:
    """The choice a text equals once case and underscores are set aside."""
    folded = F.translate(casefold(normalize_space(c)), "_", " ")
    out = F.lit("")
    for choice in reversed(choices):
        out = F.when(folded == choice.replace("_", " "), F.lit(choice)).otherwise(out)
    return out


def iso_dates(c: Column, policy: Policy = DEFAULT) -> Column:
    """All valid dates of the receipt year and the year before."""
    year = policy.receipt_date.year
    found = F.regexp_extract_all(c, F.lit(r"(?=2)(?U)\b20\d{2}-\d{2}-\d{2}\b"), F.lit(0))
    return F.filter(
        found,
        lambda d: is_calendar_date(d) & F.substring(d, 1, 4).isin(str(year - 1), str(year)),
    )


def damaged_dates(c: Column, policy: Policy = DEFAULT) -> Column:
    """Dates on an arrival-date-like line whose sixes were read as eights."""
    misread, year = policy.misread_year
    misread_month, month = policy.misread_month
    lines = F.filter(
        raw_lines(c), lambda line: line.rlike(word("a", r"a[a-z]{2,12}\s+d[a-z]{2,6}\b"))
    )
    raw = F.flatten(
        F.transform(
            lines,
            lambda line: F.regexp_extract_all(
                line, F.lit(rf"(?U)\b{misread}[-/](\d{{2}}[-/]?\d{{2}})\b"), F.lit(1)
            ),
        )
    )
    repaired = F.transform(
        raw,
        lambda r: F.concat(
            F.lit(f"{year}-"),
            F.when(F.substring(r, 1, 2) == misread_month, F.lit(month)).otherwise(F.substring(r, 1, 2)),
            F.lit("-"),
            F.right(r, F.lit(2)),
        ),
    )
    return F.filter(repaired, is_calendar_date)


def flag_array(c: Column) -> Column:
    """A '|'-joined flag set as an array; 'none' is the empty set."""
    return F.when(c == "none", F.array().cast("array<string>")).otherwise(F.split(c, r"\|"))


def ratio(numerator: Column, denominator: Column) -> Column:
    return F.round(F.try_divide(numerator.cast("double"), denominator.cast("double")), 6)


def normalize_candidate(field: Column, raw: Column, policy: Policy = DEFAULT, fuzzy: bool = True) -> Column:
    """Normalise a crop reading by the type of the field it was cropped for."""
    first = F.coalesce(F.try_element_at(F.split(rows_text(raw), "\n"), F.lit(1)), F.lit(""))
    flags = clean_flags(raw, policy) if fuzzy else exact_flags(raw, policy)
    return (
        F.when(field == "applicant_name", clean_name(first))
        .when(field == "species_code", clean_species(first))
        .when(field == "visa_class", find_visa(raw))
        .when(field == "sponsor_id", clean_sponsor(raw))
        .when(field == "arrival_date", clean_date(raw))
        .when(field == "risk_flags", flags)
        .when(field == "fee_status", exact_fee(raw))
        .when(field == "disposition", find_finding(raw))
        .otherwise(first)
    )


def apply_match(value: Column, match: Column, accept) -> Column:
    """The matched vocabulary value when it is near and unrivalled, else ``value``."""
    good = (match["score"] >= accept.score) & (match["score"] - match["runner_up"] >= accept.margin)
    return F.when(good, match["value"]).otherwise(value)


def snap_category(c: Column, options: tuple[str, ...], policy: Policy = DEFAULT) -> Column:
    accept = policy.snap_category
    match = similarity.nearest({o: _plain_key(o) for o in options}, accept.floor)
    return apply_match(c, match(F.when(~c.isin("unknown", ""), category_key(c))), accept)


def snap_purpose(c: Column, policy: Policy = DEFAULT) -> Column:
    accept = policy.snap_purpose
    match = similarity.nearest({o: _plain_key(o) for o in policy.purposes}, accept.floor)
    return apply_match(c, match(F.when(~c.isin("", *policy.purposes), category_key(c))), accept)


def snap_name(c: Column, policy: Policy = DEFAULT) -> Column:
    """Correct damaged name tokens from the token vocabulary.

    Two words are corrected one by one; of three or four words the best
    ordered pair of near tokens is kept, and nothing changes without one.
    """
    words = F.split(normalize_space(c), " ")
    count = F.size(words)
    match = similarity.nearest_each({t: t.lower() for t in policy.name_tokens}, policy.name_token_score)
    ranked = match(F.when(count.between(2, 4), F.split(casefold(normalize_space(c)), " ")))
    corrected = F.array_join(
        F.transform(
            F.zip_with(words, ranked, lambda w, m: F.struct(w.alias("w"), m.alias("m"))),
            lambda p: F.when(p["w"].isin(*policy.name_tokens) | (F.length(p["w"]) < 4), p["w"])
            .when(p["m"]["score"] >= policy.name_token_score, p["m"]["value"])
            .otherwise(p["w"]),
        ),
        " ",
    )
    ordered = F.array(
        *[
            F.when(
                (j < count)
                & (F.get(ranked, F.lit(i))["score"] >= policy.name_pair_score)
                & (F.get(ranked, F.lit(j))["score"] >= policy.name_pair_score),
                F.struct(
                    F.least(F.get(ranked, F.lit(i))["score"], F.get(ranked, F.lit(j))["score"]).alias("low"),
                    (F.get(ranked, F.lit(i))["score"] + F.get(ranked, F.lit(j))["score"]).alias("sum"),
                    F.get(ranked, F.lit(i))["value"].alias("first"),
                    F.get(ranked, F.lit(j))["value"].alias("second"),
                ),
            )
            for i in range(3)
            for j in range(i + 1, 4)
        ]
    )
    best = F.array_max(ordered)
    return (
        F.when((count == 2), corrected)
        .when(count.between(3, 4) & best.isNotNull(), F.concat_ws(" ", best["first"], best["second"]))
        .otherwise(c)
    )


def _plain_key(option: str) -> str:
    return "".join(ch for ch in option.lower() if ch.isascii() and ch.isalnum())
