"""The full card-spend audit: rules, split purchases, criteria and colour per row."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.cells import cell, number
from tallyloom.operators.relational import flag_membership, lookup_set
from tallyloom.operators.rules import (
    SPEND_LIMIT,
    SPLIT_COLOUR,
    SPLIT_NAME,
    Rule,
    apply_rules,
    rule_hits,
    spend_rules,
    split_candidate,
    with_list_flags,
)
from tallyloom.operators.splits import mark_splits, split_purchases
from tallyloom.sources.files import require_inputs
from tallyloom.sources.schemas import AUDIT_CELLS

# Sheet names, and the sheet column that holds each list.
MASTER = "Master"
LIST_CELLS = {"FPS CHs": "B", "RCM CHs": "C", "DSC": "C"}


def master_rows(sheet: DataFrame, row_index: str = "row") -> DataFrame:
    """A master sheet read by position as named, typed columns.

    Cells that hold no number or date where one belongs become NULL.
    """
    block = sheet.select([c for c in sheet.columns if c not in (row_index, "file")])
    named = {name: cell(block, letters) for letters, name in AUDIT_CELLS.items()}
    named["date"] = named["date"].try_cast("timestamp_ntz")
    named["total"] = number(named["total"].cast("string"))
    return sheet.select(F.col(row_index).alias("row_index"), *[c.alias(n) for n, c in named.items()])


def list_sets(sheets: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The three lookup lists. Their sheets have named columns already, so no header row is skipped."""
    return {
        name: lookup_set(sheets[name].select(cell(sheets[name], letters).alias("entry")), "entry")
        for name, letters in LIST_CELLS.items()
    }


def split_candidates(master: DataFrame, fps: DataFrame) -> DataFrame:
    """Rows the split detector looks at. Only the one list it needs is joined."""
    return flag_membership(master, F.col("cardholder"), fps, "in_fps").where(split_candidate()).drop("in_fps")


def audit(
    master: DataFrame, fps: DataFrame, rcm: DataFrame, dsc: DataFrame, spend_limit: float = SPEND_LIMIT, **options
) -> DataFrame:
    """Every master row with ``criteria`` and ``highlight``.

    Rows without a cardholder stay as they are. The split is the last rule: its name comes last and
    its colour wins. The master is read twice, once for the splits and once for the result.
    """
    purchases = split_purchases(split_candidates(master, fps), spend_limit, **options)
    flagged = with_list_flags(master, fps, rcm, dsc)
    marked = mark_splits(flagged, purchases, split_candidate())
    rows = marked.withColumn("in_split", F.col("split_index").isNotNull())
    rules = [*spend_rules(spend_limit), Rule(SPLIT_NAME, F.col("in_split"), SPLIT_COLOUR)]
    existing = F.col("criteria") if "criteria" in master.columns else None
    return apply_rules(rows, rules, F.col("cardholder").isNotNull(), existing)


def audit_sheets(sheets: Mapping[str, DataFrame], spend_limit: float = SPEND_LIMIT, **options) -> DataFrame:
    """Audit a workbook given as sheet name -> DataFrame; missing sheets stop it at once."""
    require_inputs(sheets, [MASTER, *LIST_CELLS])
    lists = list_sets(sheets)
    return audit(sheets[MASTER], lists["FPS CHs"], lists["RCM CHs"], lists["DSC"], spend_limit, **options)


def hits_per_rule(flagged: DataFrame, spend_limit: float = SPEND_LIMIT) -> DataFrame:
    return rule_hits(flagged, spend_rules(spend_limit), F.col("cardholder").isNotNull())
