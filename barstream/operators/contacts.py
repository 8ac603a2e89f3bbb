"""Contact table jobs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barstream.functions.columns import is_blank

# Contact fields, line order and labels of the vCard, templates.
TEXT_FIELDS = ("name", "avatarUri", "position", "phone", "email", "company", "bio")
VCARD_LINES = (
    ("phone", "TEL;TYPE=CELL:"),
    ("email", "EMAIL:"),
    ("name", "FN;CHARSET=UTF-8:"),
    ("company", "ORG;CHARSET=UTF-8:"),
    ("position", "TITLE;CHARSET=UTF-8:"),
    ("bio", "NOTE;CHARSET=UTF-8:"),
)
TEMPLATES = (0, 1, 2)
LINE_END = "\r\n"


def fill_contacts(contacts: DataFrame) -> DataFrame:
    """Missing text becomes '', a missing or unknown template becomes 0."""
    template = F.when(F.col("templateIndex").isin(*TEMPLATES), F.col("templateIndex")).otherwise(0)
    filled = {c: F.coalesce(F.col(c), F.lit("")) for c in TEXT_FIELDS}
    return contacts.withColumns({**filled, "templateIndex": template.cast("int")})


def nonempty_contacts(contacts: DataFrame) -> DataFrame:
    """Contacts with at least one non-blank text field."""
    return contacts.where(~reduce(Column.__and__, [is_blank(c) for c in TEXT_FIELDS]))


def vcard_text() -> Column:
    """vCard 3.0 text of a contact; blank fields leave no line."""
    lines = [
        F.when(~is_blank(field), F.concat(F.lit(label), F.col(field), F.lit(LINE_END))).otherwise("")
        for field, label in VCARD_LINES
    ]
    begin = F.lit(f"BEGIN:VCARD{LINE_END}VERSION:3.0{LINE_END}")
    return F.concat(begin, *lines, F.lit(f"END:VCARD{LINE_END}"))


def vcards(contacts: DataFrame, key: str) -> DataFrame:
    """(key, vcard) per contact."""
    return contacts.select(key, vcard_text().alias("vcard"))


def write_vcards(contacts: DataFrame, path: str, key: str) -> None:
    """One vCard after the other in UTF-8 text files.

    The writer adds the line feed that each card's text gives up here.
    """
    card = F.expr("substring(vcard, 1, length(vcard) - 1)")
    vcards(contacts, key).select(card.alias("vcard")).write.mode("overwrite").option("lineSep", "\n").text(path)


def fold_contacts(changes: DataFrame, key: str, seq: str = "seq") -> DataFrame:
    """Current contacts from a change log.

    A NULL field means "not written by this change", so a full save sets all
    fields and a template save one; the latest write of each field wins.
    """
    fields = (*TEXT_FIELDS, "templateIndex")
    latest = [
        F.max_by(c, F.when(F.col(c).isNotNull(), F.col(seq))).alias(c) for c in fields
    ]
    return changes.groupBy(key).agg(*latest)


def contact_profile(contacts: DataFrame, key: str) -> DataFrame:
    """Filled contact lines (phone, email, company) and the initial shown
    where there is no picture."""
    filled = [F.when(is_blank(c), 0).otherwise(1) for c in ("phone", "email", "company")]
    initial = F.when(is_blank("name"), "").otherwise(F.substring("name", 1, 1))
    return contacts.select(
        key,
        reduce(Column.__add__, filled).cast("int").alias("filled_lines"),
        F.when(is_blank("avatarUri"), initial).alias("initial"),
    )
