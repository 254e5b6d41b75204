"""Named audit rules over card transactions, evaluated together in one projection."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.relational import flag_membership, flag_memberships

# Merchant category and ledger codes the rules look for.
INTERNAL_CATEGORY = "9399"
EVENT_CATEGORY = "7932"
TRAVEL_CATEGORIES = ("7011", "4111", "7513")
TRAVEL_CODES = ("54260", "54206", "54208")
CONFERENCE_CODES = ("52334", "52136")
HOSPITALITY_CODES = ("52204", "52206", "52207", "54211")
MEMBERSHIP_CODES = ("58208", "52336", "52337")
VEHICLE_CODES = ("53332", "53334", "54285", "54287", "54000", "54002", "54004")
HOME_EQUIPMENT_CODE = "54260"
HOME_EQUIPMENT_LIMIT = 800.0
NO_SPLIT_CODE = "52008"
SPEND_LIMIT = 10000.0
SPLIT_NAME = "Potential Splits"
SPLIT_COLOUR = "OrangeRed"

# Fill colours by name.
COLOURS = {
    "Cornsilk": "FFF8DC",
    "NavajoWhite": "FFDEAD",
    "Salmon": "FA8072",
    "DarkSalmon": "E9967A",
    "RosyBrown": "BC8F8F",
    "Pink": "FFC0CB",
    "HotPink": "FF69B4",
    "Coral": "FF7F50",
    "OrangeRed": "FF4500",
    "DarkSeaGreen": "8FBC8F",
    "Aqua": "00FFFF",
    "Violet": "EE82EE",
    "Olive": "808000",
    "Gold": "FFD700",
    "Peach": "FFCC99",
}


@dataclass(frozen=True)
class Rule:
    """A named condition on a row and the colour that marks its hits."""

    name: str
    condition: Column
    colour: str


def merchant_entry() -> Column:
    """How a merchant is spelled in the list of conferences."""
    return F.coalesce(F.upper("merchant"), F.lit(""))


def with_list_flags(rows: DataFrame, fps: DataFrame, rcm: DataFrame, dsc: DataFrame) -> DataFrame:
    """Add ``in_fps``, ``in_rcm`` (cardholder as written) and ``in_dsc`` (merchant in upper case)."""
    flagged = flag_memberships(rows, F.col("cardholder"), {"in_fps": fps, "in_rcm": rcm})
    return flag_membership(flagged, merchant_entry(), dsc, "in_dsc")


def spend_rules(spend_limit: float = SPEND_LIMIT) -> list[Rule]:
    """The twelve spend rules, in reporting order.

    They read ``merchant``, ``total``, ``merchant_category``, ``gl_code`` and the list flags.
    Missing cells never match, apart from the cheque rule, which looks for an empty total.
    """
    # The rules' names and colours.
    category, code, total = F.col("merchant_category"), F.col("gl_code"), F.col("total")
    conference = code.isin(*CONFERENCE_CODES)
    return [
        Rule("Restricted IS/OGD transactions", category == INTERNAL_CATEGORY, "Cornsilk"),
        Rule(
            "Restricted Travel Status Related Expenses",
            category.isin(*TRAVEL_CATEGORIES) | code.isin(*TRAVEL_CODES),
            "NavajoWhite",
        ),
        Rule("Event/Hospitality", category == EVENT_CATEGORY, "Salmon"),
        Rule("TA Limit exceeded", total >= spend_limit, "DarkSalmon"),
        Rule(
            "Monitoring of Convenience Cheques",
            (F.col("merchant") == "CHEQUE") & total.isNull(),
            "RosyBrown",
        ),
        Rule(
            "Financial Coding Error - Designated Science Conferences",
            conference & F.col("in_dsc"),
            "Pink",
        ),
        Rule("Conference fees", conference & ~F.col("in_dsc"), "HotPink"),
        Rule("Hospitality", code.isin(*HOSPITALITY_CODES), "Gold"),
        Rule("Restricted Memberships", code.isin(*MEMBERSHIP_CODES), "Violet"),
        Rule(
            "Restricted Home Equipment Purchases",
            (code == HOME_EQUIPMENT_CODE) & (total >= HOME_EQUIPMENT_LIMIT) & ~F.col("in_fps"),
            "Olive",
        ),
        Rule("Restricted Motor Vehicles Expenses", code.isin(*VEHICLE_CODES), "DarkSeaGreen"),
        Rule("SoD - TA and s.34", F.col("in_rcm"), "Aqua"),
    ]


def split_candidate() -> Column:
    """Rows the split detector looks at: not an exempt cardholder, not the exempt ledger code."""
    return ~F.col("in_fps") & (F.coalesce("gl_code", F.lit("")) != NO_SPLIT_CODE)


def apply_rules(
    df: DataFrame,
    rules: Sequence[Rule],
    applies: Column | None = None,
    existing: Column | None = None,
    criteria: str = "criteria",
    highlight: str = "highlight",
) -> DataFrame:
    """Add the names of all matching rules in rule order and the colour of the last match.

    Names follow a non-empty ``existing`` text; rows for which ``applies`` is not true match nothing.
    """
    guard = F.lit(True) if applies is None else applies
    hits = [(guard & rule.condition, rule) for rule in rules]
    before = [] if existing is None else [F.nullif(existing, F.lit(""))]
    names = F.concat_ws(" AND ", *before, *[F.when(hit, rule.name) for hit, rule in hits])
    colours = [F.when(hit, rule.colour) for hit, rule in reversed(hits)]
    return df.withColumns({criteria: F.nullif(names, F.lit("")), highlight: F.coalesce(*colours)})


def rule_hits(df: DataFrame, rules: Sequence[Rule], applies: Column | None = None) -> DataFrame:
    """Number of rows each rule matches, rules without a hit included, in one aggregate."""
    guard = F.lit(True) if applies is None else applies
    counts = df.agg(*[F.count_if(guard & rule.condition).alias(f"h{i}") for i, rule in enumerate(rules)])
    rows = [
        F.struct(F.lit(i + 1).alias("position"), F.lit(rule.name).alias("rule"), F.col(f"h{i}").alias("hits"))
        for i, rule in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*rows)))
