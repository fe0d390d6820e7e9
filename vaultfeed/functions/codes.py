"""Codes, references and flags."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The list and rule contents that decide the flags.
POLICY_SYMBOLS = ("CU", "CCU", "UCU", "VCU", "WCU", "XCU", "YCU", "ZCU")
MAJOR_PERILS = (
    "088", "089", "090", "099", "100", "101", "102", "103", "110", "112", "114", "115", "116",
    "117", "118", "119", "120", "122", "123", "130", "133", "145", "146", "147", "148", "149",
    "151", "152", "153", "163", "165", "166", "170", "171", "172", "173", "801", "810", "845",
    "870", "124", "164", "700", "701", "710", "711", "712", "713", "720", "721", "99", "050",
    "210", "211", "501", "502", "503", "504", "506", "507", "508", "521", "532", "533", "505",
    "509", "511", "531", "540", "542", "543", "544", "550", "552", "560",
)
SUBLINES = (
    "010", "011", "012", "013", "014", "015", "016", "017", "018", "019", "091", "060", "061",
    "210", "215", "220", "225", "230", "235", "240", "245", "250", "255", "260", "265", "270",
    "275", "280", "285", "325", "332", "334", "335", "336", "342", "343", "345", "346", "347",
    "350", "360", "317", "344", "365",
)
OWN_REINSURER = "0060"
SERVICE_OFFICES = ("70",)
AGENCY_STATES = ("57", "66")
POLICY_KINDS = ("M",)
# Line of business, bureau type, coverage code: employment liability if the channel is above "01".
EMPLOYMENT_LIABILITY = (
    ("GL", "GL", "560"),
    ("CPP", "GL", "560"),
    ("BOP", "BC", "385"),
    ("BOP", "BC", "662"),
    ("ML", "BC", "362"),
)
EMPLOYMENT_LIABILITY_COVERAGE = "172"


def normalise_code(code: Column, width: int = 3) -> Column:
    """Trim and left-pad with zeros; a code longer than ``width`` is cut to it."""
    return F.lpad(F.trim(code), width, "0")


def int_text(value: Column) -> Column:
    """Whole-number text without leading zeros or a decimal part; null if not a number."""
    return F.trim(value.cast("string")).try_cast("decimal(28,6)").try_cast("int").cast("string")


def join_number(text: Column) -> Column:
    """A number held as padded text, as a join key; null if it is not a number."""
    return F.trim(text).try_cast("int")


def reference_root(reference: Column) -> Column:
    return F.substring(reference, 1, 15)


def reference_revision(reference: Column) -> Column:
    """The revision held in characters 16 to 18."""
    return F.substring(reference, 16, 3).try_cast("int")


def list_flag(code: Column, members: Sequence[str], missing: str = "") -> Column:
    """``InList`` or ``NotInList``; a null code gives ``missing``, an empty one is not in the list."""
    return (
        F.when(code.isNull(), missing)
        .when(code.isin(*members), "InList")
        .otherwise("NotInList")
    )


def reinsurer_status(code: Column) -> Column:
    """``NotInList`` for a foreign reinsurer; blank for none and for the own company."""
    return F.when((code != "") & (code != OWN_REINSURER), "NotInList").otherwise("")


def employment_liability(channel: Column, line: Column, bureau: Column, coverage: Column) -> Column:
    """``E`` where one of the employment-liability rules holds."""
    code = F.trim(coverage)
    rules = [
        (line == rule_line) & (bureau == rule_bureau) & (code == rule_code)
        for rule_line, rule_bureau, rule_code in EMPLOYMENT_LIABILITY
    ]
    by_channel = (channel > "01") & reduce(lambda a, b: a | b, rules)
    return F.when(by_channel | (code == EMPLOYMENT_LIABILITY_COVERAGE), "E").otherwise("")
