"""String columns: normalisation, classes, labels and identifiers (STR-01 to STR-07)."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Brand classes in their order, each with what a name must hold (upper-cased Latin, Hangul as written).
BRANDS = (
    ("SK에너지", ("SK", "에스케이")),
    ("GS칼텍스", ("GS", "지에스")),
    ("HD현대오일뱅크", ("현대", "HD", "오일뱅크")),
    ("S-OIL", ("S-OIL", "SOIL", "에쓰")),
    ("알뜰", ("알뜰",)),
    ("NH-OIL", ("NH", "농협")),
    ("자가상표", ("자가",)),
)
OTHER_BRAND = "기타"
# Official region names and their short forms.
REGIONS = {
    "서울특별시": "서울", "부산광역시": "부산", "대구광역시": "대구", "인천광역시": "인천", "광주광역시": "광주", "대전광역시": "대전", "울산광역시": "울산", "세종특별자치시": "세종", "경기도": "경기",
    "강원도": "강원", "강원특별자치도": "강원", "충청북도": "충북", "충청남도": "충남", "전라북도": "전북", "전북특별자치도": "전북", "전라남도": "전남", "경상북도": "경북", "경상남도": "경남", "제주도": "제주", "제주특별자치도": "제주",
}
SELF_LABELS = {"self": "셀프", "full": "일반", "unknown": "미상"}
# Texts that count as missing.
BLANK_LIKE = ("", "nan", "None", "<NA>")


def squeeze(text: Column) -> Column:
    """STR-01 without Unicode forms: white space runs become one space, ends trimmed."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def unicode_form(form: str):
    """STR-01: a vectorised function to NFC, NFKC and the like, which Spark has no built-in for."""

    @F.pandas_udf("string")
    def normal(text: pd.Series) -> pd.Series:
        return text.map(lambda s: None if s is None else unicodedata.normalize(form, s))

    return normal


def classify(text: Column, rules, other: str) -> Column:
    """STR-02, STR-03: the first class of which ``text`` (squeezed, upper-cased) holds a mark; ``other`` if none, or null or empty text."""
    upper = F.upper(squeeze(F.coalesce(text, F.lit(""))))
    out = None
    for name, marks in rules:
        hit = upper.contains(marks[0])
        for m in marks[1:]:
            hit = hit | upper.contains(m)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(other)


def brand_class(text: Column) -> Column:
    return classify(text, BRANDS, OTHER_BRAND)


def self_class(text: Column) -> Column:
    """STR-03: self-service if the text contains the label or is a flag that says so, unknown if it is blank, else full service."""
    s = F.lower(squeeze(F.coalesce(text, F.lit(""))))
    return F.when(s.contains("셀프") | s.isin("y", "true", "1", "self"), "self").when(s == "", "unknown").otherwise("full")


#: Kinds of facilities and the words that tell them, in order. Fixed values of the source files.
FACILITIES = (("storage", ("저유", "저장")), ("factory", ("공장",)), ("agency", ("대리점",)))


def facility_class(text: Column) -> Column:
    """STR-03: storage, factory or agency by the first word contained; null for others."""
    return classify(text, FACILITIES, None)


def address_variants(text: Column) -> Column:
    """STR-04: the address as it is, without parentheses, and without a trailing change note; distinct, in order."""
    bare = squeeze(F.regexp_replace(text, r"\([^)]*\)", " "))
    return F.array_distinct(F.array(squeeze(text), bare, squeeze(F.regexp_replace(bare, r"\s*-\s*(변경|등록).*$", ""))))


def short_region(name: Column) -> Column:
    """STR-05: official region names become short ones; others stay."""
    pairs = F.create_map(*[F.lit(x) for pair in REGIONS.items() for x in pair])
    return F.coalesce(F.try_element_at(pairs, name), name)


def blank_to_null(text: Column) -> Column:
    """STR-06: blank-like texts are null."""
    t = F.trim(text)
    return F.when(~t.isin(*BLANK_LIKE), t)


def is_station_id(text: Column) -> Column:
    return F.coalesce(text.rlike(r"^A\d+$"), F.lit(False))


def grid_id(cell: int, col: Column, row: Column) -> Column:
    """STR-07: G{cell}_{col}_{row}."""
    return F.concat(F.lit(f"G{cell}_"), col.cast("string"), F.lit("_"), row.cast("string"))
