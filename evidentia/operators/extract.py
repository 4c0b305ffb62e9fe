"""From readings (text) to facts (case, fact, value, provenance).

A reading is one text of one page. Everything here is per reading, so the
extraction of a whole corpus is a single scan and projection; facts are
narrow, and only they are ever shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from evidentia import policy as fixed
from evidentia.functions import fields as fn, similarity, text as tx
from evidentia.policy import DEFAULT, Policy

KINDS = tuple(fixed.PRECEDENCE)
ATTESTATION_PARTS = ("sponsor", "applicant", "purpose", "visa")


# -- page level ------------------------------------------------------------


def page_kind(text: Column) -> Column:
    """Kind with the most marker phrases; the first declared kind wins a tie."""
    folded = tx.casefold(text)
    step = len(fixed.PAGE_MARKERS)
    votes, outcome = [], {}
    for position, (kind, markers) in enumerate(fixed.PAGE_MARKERS.items()):
        rank = step - 1 - position
        score = sum((F.contains(folded, F.lit(m)).cast("int") for m in markers), start=F.lit(0))
        votes.append(score * step + rank)
        needed = 1 if kind in fixed.SINGLE_MARKER_KINDS else 2
        outcome.update({n * step + rank: kind if n >= needed else "other" for n in range(len(markers) + 1)})
    # one number holds score and rank, and is the place of its outcome
    places = F.array(*[F.lit(outcome.get(i, "other")) for i in range(max(outcome) + 1)])
    return F.coalesce(F.get(places, F.greatest(*votes)), F.lit("other"))


def precedence(kind: Column) -> Column:
    weight = F.lit(fixed.PRECEDENCE["other"])
    for name, value in fixed.PRECEDENCE.items():
        weight = F.when(kind == name, F.lit(value)).otherwise(weight)
    return weight


def source_bit(kind: Column) -> Column:
    bit = F.lit(0)
    for position, name in enumerate(KINDS):
        bit = F.when(kind == name, F.lit(1 << position)).otherwise(bit)
    return bit


def label_mask(text: Column) -> Column:
    """Which schema labels a text contains, as a bit set."""
    folded = tx.anchor_text(text)
    mask = F.lit(0)
    for bit, label in enumerate(fixed.ORIENTATION_LABELS):
        mask = mask + F.when(F.contains(folded, F.lit(label)), F.lit(1 << bit)).otherwise(F.lit(0))
    return mask


def label_score(text: Column) -> Column:
    return F.bit_count(label_mask(text))


def clean_biometrics(text: Column) -> Column:
    # few texts hold both words, and only those are reduced to their anchors
    folded = tx.casefold(text)
    held = F.contains(folded, F.lit("flags")) & F.contains(folded, F.lit("none"))
    return held & tx.anchor_text(text).rlike("(?:observed|risk) flags none")


def dedupe_readings(readings: DataFrame) -> DataFrame:
    """One row per distinct text of a page: native before retry, then lowest number."""
    order = F.struct((F.col("channel") != "native").alias("late"), "reading_no")
    kept = readings.groupBy("case_id", "page", "text").agg(F.min(order).alias("first"))
    return kept.select(
        "case_id",
        "page",
        F.col("first.reading_no").alias("reading_no"),
        F.when(F.col("first.late"), "retry").otherwise("native").alias("channel"),
        "text",
    )


def orient_pages(angled: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """Rotation chosen per page from label evidence in ``(case_id, page, angle, text)``.

    Angle 0 holds the native readings. A rotation is accepted only when the
    page is nearly unlabelled, the rotated text has enough labels and clearly
    more than the native text, and it beats the other rotation.
    """
    # a column of its own: inside the conditions every label would fold the text anew
    masked = angled.select("case_id", "page", "angle", label_mask(F.col("text")).alias("mask"))

    def score(angle: int) -> Column:
        return F.coalesce(F.bit_count(F.bit_or(F.when(F.col("angle") == angle, F.col("mask")))), F.lit(0))

    scored = masked.groupBy("case_id", "page").agg(
        score(0).alias("native"), score(90).alias("left"), score(270).alias("right")
    )
    best = F.greatest("left", "right")
    accept = (
        (F.col("native") < policy.orientation_max_native)
        & (best >= policy.orientation_min_labels)
        & (best - F.col("native") >= policy.orientation_min_gain)
        & (F.col("left") != F.col("right"))
    )
    return scored.withColumn(
        "rotation",
        F.when(~accept, 0).when(F.col("left") > F.col("right"), 90).otherwise(270),
    )


# -- prose patterns --------------------------------------------------------


def manual_finding(text: Column) -> Column:
    """A finding printed as ``Finding: X``; watermark-like words do not count."""
    raw = F.regexp_extract(text, tx.word("f", rf"Finding\s*:\s*({fixed.FINDING_PATTERN})\b"), 1)
    return fn.finding_token(raw)


_CORRECTIONS = {
    "applicant_name": (r"applicant\s+is", fixed.NAME_PAIR_PATTERN, fn.clean_name),
    "sponsor_id": (r"sponsor\s+is", r"SPN[- ]?\d{4}", fn.clean_sponsor),
    "visa_class": (r"visa\s+class\s+is", fixed.VISA_PATTERN, fn.visa_token),
    "fee_status": (r"fee\s+status\s+is", "paid|unpaid|waived", F.lower),
}


def manual_corrections(text: Column) -> dict[str, Column]:
    """Values stated by ``Manual correction: <field> is <value>`` sentences."""
    return {
        name: clean(
            F.regexp_extract(
                text, tx.word("m", rf"Manual\s+correction\s*:\s*{subject}\s+({value})\b"), 1
            )
        )
        for name, (subject, value, clean) in _CORRECTIONS.items()
    }


def attestation(text: Column, policy: Policy = DEFAULT) -> dict[str, Column]:
    """The facts bound to one sponsor sentence; all '' without one.

    Purpose must follow the sentence directly and be in the vocabulary; the
    visa class may appear within the next 600 characters.
    """
    sentence = tx.word(
        "s",
        rf"Sponsor\s+(SPN[- ]?\d{{4}})\s+attests\s+that\s+({fixed.NAME_PAIR_PATTERN})"
        r"\s+is\s+expected\b((?s:.{0,600}))",
    )
    sponsor = F.regexp_extract(text, sentence, 1)
    rest = F.regexp_extract(text, sentence, 3)
    said = tx.casefold(
        tx.normalize_space(
            F.regexp_extract(rest, r"(?iU)\A\s+on\s+Earth\s+for\s+([^.\n]{2,40})\.", 1)
        )
    )
    known = F.create_map(*[F.lit(x) for o in policy.purposes for x in (o.lower(), o)])
    purpose = F.coalesce(F.try_element_at(known, said), F.lit(""))
    visa = fn.visa_token(
        F.regexp_extract(
            rest,
            tx.word("r", rf"responsibility\s+for\s+class\s+({fixed.VISA_PATTERN})\s+compliance\b"),
            1,
        )
    )
    return {
        "sponsor": fn.clean_sponsor(sponsor),
        "applicant": fn.clean_name(F.regexp_extract(text, sentence, 2)),
        "purpose": purpose,
        "visa": visa,
    }


def approximate_applicants(readings: DataFrame, text: Column, policy: Policy = DEFAULT) -> DataFrame:
    """Adds ``approximate``: names after an applicant-like word of ``text``.

    Conflict evidence only. The words are judged by similarity, so all words
    of plausible length go through the scoring UDF as one array per text.
    """
    # all but letters, apostrophe, hyphen and line feed; the negated class takes ten times as long
    other = r"[\x00-\x09\x0b-\x26\x28-\x2c\x2e-\x40\x5b-\x60\x7b-\x{10ffff}]+"
    words = F.regexp_replace(F.regexp_replace(text, tx.LINE_BREAK, "\n"), other, " ")
    # A word can be that similar only if at most three of its letters are not
    # letters of the label (matched letters must occur in both).
    near = "(?=(?i:[aplicnt]*+(?:[a-z'-][aplicnt]*+){0,3}) )"
    span = r"[A-Za-z'-]{5,12}(?: (?i:name)(?= ))?+ [A-Za-z'-]+ [A-Za-z'-]+"
    spans = F.regexp_extract_all(words, F.lit(rf"(?<![A-Za-z'-]){near}(?=({span}))"), F.lit(1))
    like = similarity.first_word_like("applicant", policy.label_score)
    staged = readings.withColumn("spans", spans)
    names = F.zip_with(
        F.col("spans"),
        F.coalesce(
            like(F.when(F.size("spans") > 0, F.col("spans"))), F.array().cast("array<boolean>")
        ),
        lambda s, hit: F.when(hit, fn.clean_name(F.substring_index(s, " ", -2))).otherwise(F.lit("")),
    )
    found = F.array_distinct(F.filter(names, lambda n: n != ""))
    return staged.withColumn("approximate", found).drop("spans")


def category_hits(text: Column, kind: Column, policy: Policy = DEFAULT) -> dict[str, Column]:
    """Vocabulary values contained in a text as whole words, per field.

    Purposes are ordinary words, so they count only on intake and sponsor pages.
    """
    nothing = F.array().cast("array<string>")
    out = {}
    for name, options in policy.vocabulary.items():
        listed = lambda p, options=options: F.array(*[F.when(F.contains(p, F.lit(f" {_anchor(o)} ")), F.lit(o)) for o in options])
        hits = F.array_compact(F.transform(F.array(padded(text)), lambda p: listed(p))[0])
        out[name] = F.when(kind.isin("intake", "sponsor"), hits).otherwise(nothing) if name == "declared_purpose" else hits
    return out


def padded(text: Column) -> Column:
    """Folded words between single spaces, so that whole words are found as plain text."""
    return F.concat(F.lit(" "), tx.anchor_text(text), F.lit(" "))


def category_masks(words: Column, kind: Column, policy: Policy = DEFAULT) -> dict[str, Column]:
    """Per field the values contained in ``padded`` words as a bit set; bits follow the sorted values.

    Bit sets of a case are folded with ``bit_or``, whatever the number of its readings.
    ``words`` should be a column of its own, as every value looks at it.
    """
    out = {}
    for name, options in policy.vocabulary.items():
        mask = F.lit(0).cast("long")
        for i, option in enumerate(sorted(options)):
            mask = mask + F.when(F.contains(words, F.lit(f" {_anchor(option)} ")), F.lit(1 << i)).otherwise(F.lit(0))
        out[name] = F.when(kind.isin("intake", "sponsor"), mask).otherwise(F.lit(0)) if name == "declared_purpose" else mask
    return out


def categories_of_mask(name: str, mask: Column, policy: Policy = DEFAULT) -> Column:
    """The values of a field's bit set."""
    values = sorted(policy.vocabulary[name])
    return F.array_compact(F.array(*[F.when(mask.bitwiseAND(F.lit(1 << i)) != 0, F.lit(o)) for i, o in enumerate(values)]))


def category_summary(masks: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """(case_id, field, first_value, hits, only_value) of ``category_masks`` by case; fields without a hit give no row."""
    names = list(policy.vocabulary)
    folded = masks.groupBy("case_id").agg(*[F.bit_or(n).alias(n) for n in names])
    rows = folded.unpivot(["case_id"], names, "field", "mask").filter(F.col("mask") != 0)
    values = F.create_map(*[x for n in names for x in (F.lit(n), F.array(*[F.lit(o) for o in sorted(policy.vocabulary[n])]))])
    # the bits below the lowest one set number its place
    lowest = F.bit_count(F.col("mask").bitwiseAND(-F.col("mask")) - 1)
    first, hits = F.get(F.element_at(values, F.col("field")), lowest), F.bit_count("mask").cast("long")
    return rows.select(
        "case_id", "field", first.alias("first_value"), hits.alias("hits"), F.when(hits == 1, first).otherwise("").alias("only_value")
    )


def adverse_flags(text: Column, policy: Policy = DEFAULT) -> Column:
    """Flags outside lines that carry instruction words, joined by '|'."""
    words, first = "|".join(fixed.INSTRUCTION_WORDS), "".join({w[0]: w for w in fixed.INSTRUCTION_WORDS})
    kept = F.filter(tx.raw_lines(text), lambda line: ~line.rlike(tx.word(first, rf"({words})\b")))
    outside = fn.contained_flags(fn.underscored(F.array_join(kept, "\n")), policy)
    # lines are looked at one by one only in a text that has a flag at all
    return F.when(text.isNotNull() & (fn.flag_mask(fn.underscored(text), policy) == 0), F.lit("")).otherwise(outside)


def name_pairs(text: Column) -> tuple[Column, Column]:
    """First and second words of every adjacent pair within a line, aligned.

    Words and line ends are taken in order, then put beside their successors,
    so words of any length stay whole.
    """
    lines = F.regexp_replace(text, tx.LINE_BREAK, "\n")
    parts = F.regexp_extract_all(lines, F.lit("[A-Za-z][A-Za-z'-]*+|\n"), F.lit(0))
    rest = F.greatest(F.size(parts) - 1, F.lit(0))
    beside = F.zip_with(F.slice(parts, 1, rest), F.slice(parts, 2, rest), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    pairs = F.filter(beside, lambda p: (p["a"] != "\n") & (p["b"] != "\n"))
    return F.transform(pairs, lambda p: p["a"]), F.transform(pairs, lambda p: p["b"])


# -- one reading to typed evidence ----------------------------------------


# label pattern, and a literal every match contains once folded
_LABELS = {
    "applicant_name": ("Applicant Name", "applicant name"),
    "applicant": ("Applicant", "applicant"),
    "registry_name": ("Registry Name", "registry name"),
    "species": ("Species(?: Code)?", "species"),
    "home_world": ("Home World", "home world"),
    "sponsor_id": ("Sponsor ID", "sponsor id"),
    "sponsor": ("Sponsor", "sponsor"),
    "arrival_date": ("Arrival Date", "arrival date"),
    "declared_purpose": ("Declared Purpose", "declared purpose"),
    "purpose": ("Purpose", "purpose"),
    "fee_status": ("Fee Status", "fee status"),
    "observed_flags": ("Observed Flags", "observed flags"),
    "risk_flags": ("Risk Flags", "risk flags"),
    "flag": ("(?:Risk )?Flag", "flag"),
    "registry_status": ("Registry Status", "registry status"),
    "finding": ("Finding", "finding"),
}


def having(literal: str, value: Column, otherwise: Column | None = None) -> Column:
    """``value`` only where the folded text (or its rows) contains the literal.

    A byte search is far cheaper than a case-insensitive pattern, and most
    texts contain few of the labels.
    """
    present = F.contains(F.col("folded"), F.lit(literal))
    if " " in literal:
        # the words of a label may be separated by other spaces in the text
        # than in its normalised rows
        present = present | F.contains(F.col("folded_rows"), F.lit(literal))
    return F.when(present, value).otherwise(F.lit("") if otherwise is None else otherwise)


def read_labels(readings: DataFrame, policy: Policy = DEFAULT, fuzzy: bool = True) -> DataFrame:
    """Adds ``found``: the typed evidence of a reading in emission order.

    Every page kind is read for every label. Each stage materialises what the
    next one refers to more than once, which keeps expressions small.
    """
    text, kind = F.col("text"), F.col("kind")
    page = readings.withColumns(
        {"rows": tx.rows_text(text), "kind": page_kind(text), "folded": tx.casefold(text)}
    ).withColumn("folded_rows", tx.casefold(F.col("rows")))
    page = page.withColumns(
        {
            # a lambda keeps these many readers out of whole-stage code, where they
            # would be one method, too long for the JVM to compile
            "row_array": F.filter(F.split("rows", "\n"), lambda line: line != ""),
            **{
                f"label_{n}": having(literal, tx.extract_label(text, F.col("rows"), pattern))
                for n, (pattern, literal) in _LABELS.items()
            },
        }
    )
    label, row_array = {n: F.col(f"label_{n}") for n in _LABELS}, F.col("row_array")
    page = page.withColumns(
        {
            "flag_text": tx.first_nonempty(label["observed_flags"], label["risk_flags"]),
            "note_text": F.when(kind == "note", tx.first_nonempty(label["flag"], text)),
        }
    )
    page = page.withColumns(
        {
            "flags": F.when(F.col("flag_text") != "", fn.exact_flags(F.col("flag_text"), policy)).otherwise(F.lit("")),
            "note_flags": F.coalesce(fn.exact_flags(F.col("note_text"), policy), F.lit("")),
        }
    )
    if fuzzy:
        match = similarity.nearest_each({f: f for f in policy.flags}, policy.fuzzy_flag.floor)
        page = page.withColumns(
            {
                f"near_{n}": match(F.when(F.col(n) == "", fn.flag_tokens(F.col(f"{t}_text"))))
                for n, t in (("flags", "flag"), ("note_flags", "note"))
            }
        )
        page = page.withColumns(
            {
                n: tx.first_nonempty(F.col(n), fn.recovered_flags(F.col(f"near_{n}"), policy))
                for n in ("flags", "note_flags")
            }
        ).drop("near_flags", "near_note_flags")
    def cleaned(name: str, clean) -> Column:
        return F.when(label[name] != "", clean(label[name]))

    name = tx.first_nonempty(
        cleaned("applicant_name", fn.clean_name),
        cleaned("applicant", fn.clean_name),
        having("applicant name", tx.value_before_label(row_array, "Applicant Name", fn.clean_name)),
        having("applicant", tx.value_before_label(row_array, "Applicant", fn.clean_name)),
        cleaned("registry_name", fn.clean_name),
    )
    sponsor = tx.first_nonempty(
        cleaned("sponsor_id", fn.clean_sponsor),
        cleaned("sponsor", fn.clean_sponsor),
        having("sponsor id", tx.value_before_label(row_array, "Sponsor ID", fn.clean_sponsor)),
        having("sponsor", tx.value_before_label(row_array, "Sponsor", fn.clean_sponsor)),
        F.when(kind == "sponsor", fn.clean_sponsor(text)),
    )
    embargo = (kind == "registry") & label["registry_status"].rlike(tx.word("e", r"embargo\b"))
    pairs = {
        "name": name,
        "species": tx.first_nonempty(cleaned("species", fn.clean_species)),
        "world": label["home_world"],
        "visa": fn.find_visa(text),
        "sponsor": sponsor,
        "date": tx.first_nonempty(cleaned("arrival_date", fn.clean_date)),
        "purpose": tx.first_nonempty(label["declared_purpose"], label["purpose"]),
        "paid": tx.first_nonempty(cleaned("fee_status", fn.exact_fee)),
        "noted": F.when(kind == "note", fn.find_finding(tx.first_nonempty(label["finding"], text))).otherwise(F.lit("")),
        "embargo": F.when(embargo, F.lit("true")).otherwise(F.lit("")),
    }
    page = page.withColumns({f"read_{n}": v for n, v in pairs.items()})
    read = {n: F.col(f"read_{n}") for n in pairs}
    emitted = [
        ("applicant_name", read["name"]),
        ("species_code", read["species"]),
        ("home_world", read["world"]),
        ("visa_class", read["visa"]),
        ("sponsor_id", read["sponsor"]),
        ("arrival_date", read["date"]),
        ("declared_purpose", read["purpose"]),
        ("fee_status", read["paid"]),
        ("risk_flags", F.col("flags")),
        ("registry_embargo_review", read["embargo"]),
        ("risk_flags", F.col("note_flags")),
    ]
    return page.withColumns(
        {"found": _facts([(f"field:{n}", v) for n, v in emitted]), "noted": read["noted"]}
    ).drop(
        "rows", "folded_rows", "row_array", "flag_text", "note_text", "flags", "note_flags",
        *[f"label_{n}" for n in _LABELS], *[f"read_{n}" for n in pairs],
    )


FACT = "struct<fact:string,value:string,ordinal:int>"


def _facts(pairs) -> Column:
    return F.array_compact(
        F.array(
            *[
                F.when(
                    value != "",
                    F.struct(
                        F.lit(name).alias("fact"), value.alias("value"), F.lit(i).alias("ordinal")
                    ),
                )
                for i, (name, value) in enumerate(pairs)
            ]
        )
    )


def _facts_of_array(name: str, values: Column) -> Column:
    return F.transform(
        values,
        lambda v: F.struct(F.lit(name).alias("fact"), v.alias("value"), F.lit(0).alias("ordinal")),
    )


def evidence(readings: DataFrame, policy: Policy = DEFAULT, fuzzy: bool = True) -> DataFrame:
    """Typed evidence, one row per emitted value (label readers only)."""
    exploded = read_labels(readings, policy, fuzzy).select(
        "case_id", "channel", "page", "reading_no", "kind", F.explode_outer("found").alias("f")
    ).filter(F.col("f").isNotNull())
    return exploded.select(
        "case_id",
        "channel",
        "page",
        "reading_no",
        F.col("f.ordinal").alias("ordinal"),
        F.substring_index("f.fact", ":", -1).alias("field"),
        F.col("f.value").alias("value"),
        F.col("kind").alias("source"),
        precedence(F.col("kind")).alias("weight"),
    )


def facts(
    readings: DataFrame,
    policy: Policy = DEFAULT,
    fuzzy: bool = True,
    deduplicated: bool = False,
) -> DataFrame:
    """Every fact of every reading, in long form.

    Repeated texts of a page are dropped after extraction, by text hash within
    the page, so that the shuffle carries facts instead of texts. Pass
    ``deduplicated`` when ingestion has already done so.
    """
    text, kind = F.col("text"), F.col("kind")
    native = F.col("channel") == "native"
    page = read_labels(readings, policy, fuzzy).withColumn("words", padded(text))
    page = page.withColumns(
        {
            **{f"attested_{n}": having("attests", v) for n, v in attestation(text, policy).items()},
            **{f"corrected_{n}": having("manual", v) for n, v in manual_corrections(text).items()},
            "fee": F.when(F.contains("folded", F.lit("fee")), fn.anchored_fee(text, policy, fuzzy)).otherwise(F.lit("")),
            "adverse": adverse_flags(text, policy),
            **{f"mask_{n}": v for n, v in category_masks(F.col("words"), kind, policy).items()},
            "manual": having("finding", manual_finding(text)),
            "calm": clean_biometrics(text),
        }
    )
    if fuzzy:
        page = approximate_applicants(page, F.when(native, text).otherwise(F.lit("")), policy)
    attested = {n: F.col(f"attested_{n}") for n in ATTESTATION_PARTS}
    scalar = _facts(
        [
            ("manual_finding", F.col("manual")),
            *[
                (
                    f"note:{value}",
                    F.when((kind == "note") & (F.col("noted") == value), F.lit("true")).otherwise(F.lit("")),
                )
                for value in ("DENIED", "NEEDS_REVIEW")
            ],
            ("note_page", F.when(kind == "note", F.lit("true")).otherwise(F.lit(""))),
            *[
                (f"correction:{n}", F.when(native, F.col(f"corrected_{n}")).otherwise(F.lit("")))
                for n in _CORRECTIONS
            ],
            ("attested_name", F.when(native, attested["applicant"]).otherwise(F.lit(""))),
            (
                "attestation",
                F.when(
                    native & (attested["sponsor"] != "") & (attested["applicant"] != ""),
                    F.concat_ws("|", *[attested[p] for p in ATTESTATION_PARTS]),
                ).otherwise(F.lit("")),
            ),
            (
                "whole_fee",
                F.when(native & F.col("fee").isin("paid", "waived"), F.col("fee")).otherwise(F.lit("")),
            ),
            (
                "clean_biometrics",
                F.when(native & F.col("calm"), F.lit("true")).otherwise(F.lit("")),
            ),
            ("adverse", F.col("adverse")),
        ]
    )
    nothing = F.array().cast("array<string>")
    listed = [
        _facts_of_array(f"category:{n}", categories_of_mask(n, F.col(f"mask_{n}"), policy)) for n in policy.vocabulary
    ]
    listed.append(_facts_of_array("iso_date", fn.iso_dates(text, policy)))
    listed.append(
        _facts_of_array("damaged_date", F.when(native, having(policy.misread_year[0], fn.damaged_dates(text, policy), nothing)).otherwise(nothing))
    )
    listed.append(
        _facts_of_array(
            "sponsor_read",
            F.when(
                native,
                F.filter(
                    having("spn", fn.repaired_sponsors(text), nothing),
                    lambda s: s != fixed.SENTINELS["sponsor_id"],
                ),
            ).otherwise(nothing),
        )
    )
    if fuzzy:
        listed.append(
            _facts_of_array("approximate_name", F.col("approximate"))
        )
    page = page.select(
        "case_id",
        "channel",
        "page",
        "reading_no",
        "kind",
        F.sha2("text", 256).alias("text_key"),
        F.concat("found", scalar, *listed).alias("facts"),
    )
    if not deduplicated:
        order = F.struct((F.col("channel") != "native").alias("late"), "reading_no")
        page = (
            page.groupBy("case_id", "page", "text_key")
            .agg(F.min_by(F.struct("channel", "reading_no", "kind", "facts"), order).alias("first"))
            .select("case_id", "page", "first.*")
        )
    exploded = page.select("case_id", "channel", "page", "reading_no", "kind", F.explode_outer("facts").alias("f"))
    # explode_outer: plain explode would make the optimizer evaluate the whole
    # extraction a second time in a pushed-down "array is not empty" filter
    return exploded.filter(F.col("f").isNotNull()).select(
        "case_id",
        "channel",
        "page",
        "reading_no",
        F.col("f.ordinal").alias("ordinal"),
        F.col("f.fact").alias("fact"),
        F.col("f.value").alias("value"),
        F.col("kind").alias("source"),
        precedence(F.col("kind")).alias("weight"),
    )


def fuzzy_categories(readings: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """Per case the uniquely near-exact species and world, '' when there is none.

    Meant for the few cases without an exact hit; callers restrict ``readings``
    to them first. Scores fold with ``max`` per vocabulary value, so a case of
    any size needs constant state.
    """
    accept = policy.fuzzy_window
    names = ("species_code", "home_world")
    groups = []
    for name in names:
        sized: dict[int, list[str]] = {}
        for option in policy.vocabulary[name]:
            sized.setdefault(len(_anchor(option).split()), []).append(option)
        groups += [(name, sized[size]) for size in sorted(sized)]
    score = similarity.text_windows([[_anchor(o) for o in group] for _, group in groups], accept.floor)
    out = readings.select("case_id", score(tx.anchor_text(F.col("text"))).alias("scores"))
    places = [(name, option) for name, group in groups for option in group]
    aggregates = [F.max(F.get("scores", F.lit(i))).alias(f"{name}:{option}") for i, (name, option) in enumerate(places)]
    results = []
    for name in names:
        ranked = F.sort_array(
            F.array(
                *[F.struct(F.col(f"`{name}:{o}`").alias("score"), F.lit(o).alias("value")) for o in policy.vocabulary[name]]
            ),
            asc=False,
        )
        good = (ranked[0]["score"] >= accept.score) & (
            ranked[0]["score"] - ranked[1]["score"] >= accept.margin
        )
        results.append(F.when(good, ranked[0]["value"]).otherwise(F.lit("")).alias(f"fuzzy_{name}"))
    return out.groupBy("case_id").agg(*aggregates).select("case_id", *results)


def name_fallback(readings: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """Per case the most frequent near-vocabulary name pair; '' on a tie."""
    from evidentia.operators.resolve import mode_without_tie

    pairs = similarity.near_pairs({t: t.lower() for t in policy.name_tokens}, policy.name_pair_score)
    lines = F.regexp_replace("text", tx.LINE_BREAK, "\n")
    found = readings.select("case_id", F.explode_outer(pairs(lines)).alias("value"))
    named = found.filter(F.col("value").isNotNull())
    return mode_without_tie(named, ["case_id"], "value", "name")


def _anchor(option: str) -> str:
    return " ".join("".join(ch if ch.isascii() and ch.isalnum() else " " for ch in option.lower()).split())
