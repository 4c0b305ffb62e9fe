"""Golden cases of the normalisers and validators."""

from pyspark.sql import functions as F

from evidentia.functions import fields as fn, similarity, text as tx
from evidentia.policy import Policy


def label(pattern):
    return lambda c: tx.extract_label(c, tx.rows_text(c), pattern)


def test_extract_label(values):
    assert values(label("Fee Status"), ["Fee Status\npaid\nAmount\n$809", "Fee Status", "x"]) == ["paid", "", ""]
    assert values(label("Species(?: Code)?"), ["Species Code\nVENUSIAN_MYCELIAL"]) == ["VENUSIAN_MYCELIAL"]
    assert values(label("Observed Flags"), ["Observed flags: biohazard_red"]) == ["biohazard_red"]
    # a matched own-row label wins even over punctuation only
    assert values(label("Purpose"), ["Purpose\n.,\nPurpose: transit"]) == [""]


def test_value_before_label(values):
    text = "Case ID\nCASE-1\nIxodane Luzarn\nApplicant\nSpecies Code"
    got = values(lambda c: tx.value_before_label(tx.rows(c), "Applicant(?: Name)?", fn.clean_name), [text, "Applicant"])
    assert got == ["Ixodane Luzarn", ""]


def test_clean_name(values):
    texts = ["Case ID", "Species Code", "is Nexix Nexvara", "Ludane Qorvoss PASSPORT IMAGE", "one", "a b c d e", None]
    assert values(fn.clean_name, texts) == ["", "", "Nexix Nexvara", "Ludane Qorvoss", "", "A B C D", None]


def test_dates_and_sponsors(values):
    assert values(fn.clean_date, ["on 2026/02/28.", "2026-02-30", "2026-02-30 2026-02-01", "none"]) == [
        "2026-02-28", "", "", "",
    ]
    assert values(fn.clean_sponsor, ["spn 1234", "SPN-12345", "x"]) == ["SPN-1234", "", ""]
    assert values(fn.repaired_sponsors, ["Sponsor ID: SPN-OI2B"]) == [["SPN-0128"]]
    assert values(fn.iso_dates, ["2026-03-23 and 2028-03-23 and 2026-02-30"]) == [["2026-03-23"]]
    damaged = ["Antval Date: 2028-08-12", "decoy 2028-08-12", "Arrival Date: 2028-05-09"]
    assert values(fn.damaged_dates, damaged) == [["2026-06-12"], [], ["2026-05-09"]]


def test_flags(values):
    texts = ["bichaxard_yed", "SAMPLE DENIAL", "ordinary administrative narrative", "Clear", "sponsor mismatch; ACTIVE-WARRANT"]
    assert values(fn.clean_flags, texts) == ["biohazard_red", "", "", "none", "active_warrant|sponsor_mismatch"]
    # flags that share a letter are both contained
    assert values(fn.exact_flags, ["illegible_biometricsponsor_mismatch"]) == [
        "illegible_biometrics|sponsor_mismatch"
    ]


def test_anchored_fee(values):
    texts = [
        "Fee Status: paid", "Fee Status: waved", "Fee Receipt\n$809.00", "Fee Receipt\n$0.00",
        "Mandatory fee unpaid", "Fee Receipt\nFee Status: waived",
    ]
    assert values(fn.anchored_fee, texts) == ["paid", "waived", "paid", "", "", "waived"]


def test_visa_and_enum(values):
    assert values(fn.find_visa, ["class xw 2 x", "XW2", "med-3", "none"]) == ["XW-2", "XW2", "MED-3", ""]
    assert values(fn.output_visa, ["XW2", "MED-3", "unknown"]) == ["XW-2", "MED-3", "unknown"]
    assert values(lambda c: fn.exact_enum(c, ("paid", "not_paid")), [" Not paid ", "x"]) == ["not_paid", ""]


def test_case_folding(values):
    assert values(tx.anchor_text, ["Straße — ﬁn", "A B"]) == ["strasse fin", "a b"]
    assert values(tx.normalize_space, [" a \tb\x1f ", None]) == ["a b", ""]


def test_snapping(values):
    worlds = ("Barnard-c", "Mars Dome-7")
    assert values(lambda c: fn.snap_category(c, worlds), ["Barmard-c", "zzzz"]) == ["Barnard-c", "zzzz"]
    policy = Policy(purposes=("field repair", "research", "transit"))
    assert values(lambda c: fn.snap_purpose(c, policy), ["flaid repair", "unrelated prose"]) == [
        "field repair", "unrelated prose",
    ]
    names = Policy(name_tokens=("Ixomora", "Miravoss", "Qornax", "Qorzarn"))
    got = values(
        lambda c: fn.snap_name(c, names),
        ["Xomora Miravoss", "Qor Miravoss", "COPY Ixomora Miravoss", "unrelated damaged prose", "single"],
    )
    assert got == ["Ixomora Miravoss", "Qor Miravoss", "Ixomora Miravoss", "unrelated damaged prose", "single"]


def test_similarity_floor_is_lossless():
    """Bounds may only zero scores that are below the floor."""
    import random
    from difflib import SequenceMatcher

    ratio, rng = similarity.make_ratio(), random.Random(7)
    for _ in range(3000):
        a, b = ("".join(rng.choice("abcde ") for _ in range(rng.randint(0, 9))) for _ in "ab")
        exact = SequenceMatcher(None, a, b).ratio()
        got = ratio(a, b, 0.6)
        assert got == exact or (got == 0.0 and exact < 0.6)
