"""Field normalizers as column expressions, applied table-wide.

Each normalizer has two steps. ``stage`` runs the costly text work once per cell; ``finish`` reads the staged columns
several times (range tests, vocabulary branches) to give the value. :func:`normalize_cells` puts the two steps in
separate projections and binds what is staged between them, so a regex never gets copied into every branch.

No normalizer raises: text that cannot be read gives NULL (or the vocabulary's own "unknown").
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.fence import bound
from cohortloom.functions.text import (
    ANY_SPACE,
    ascii_digits,
    cell,
    is_blank_spaced,
    lookup,
    normalize_text,
    one_of,
    single_spaced,
    strip,
)
from cohortloom.schema import AGE_CAP

# Accepted spellings of sex.
MALE_TOKENS = ("m", "male", "1", "man", "xy")
FEMALE_TOKENS = ("f", "female", "2", "woman", "xx")

# Whole-cell spellings of a diagnosis.
DIAGNOSIS_TOKENS = {
    "AD": ("ad", "load", "eoad"),
    "MCI": ("mci", "ci"),
    "CONTROL": ("control", "controls", "ctrl", "ctl", "nc", "hc", "normal", "healthy", "unaffected"),
}

# Phrases looked for inside a diagnosis, first hit wins.
DIAGNOSIS_PHRASES = (
    ("MCI", ("mild cognitive impairment", "cognitive impairment")),
    ("AD", ("alzheimer",)),
    (
        "CONTROL",
        (
            "non-demented",
            "nondemented",
            "no dementia",
            "cognitively normal",
            "cognitively unimpaired",
            "healthy control",
        ),
    ),
    (
        "OTHER",
        (
            "frontotemporal",
            "lewy",
            "vascular dementia",
            "parkinson",
            "progressive supranuclear",
            "dementia",
        ),
    ),
)

# Qualifiers that do not change a diagnosis.
DIAGNOSIS_QUALIFIERS = ("probable", "definite", "possible", "suspected")

# Roman Braak stages and worded CERAD scores.
ROMAN_STAGES = {"i": 1, "ii": 2, "iii": 3, "iv": 4, "v": 5, "vi": 6}
CERAD_LABELS = {"none": 0, "zero": 0, "sparse": 1, "mild": 1, "moderate": 2, "frequent": 3, "severe": 3}

# Words that may surround a score, and the spellings of a censored age.
BRAAK_WORDS = r"braak|stage|nft|score"
CERAD_WORDS = r"cerad|score|plaques?|neuritic"
CENSORED_AGE = r"(?i)90{s}*\+|90{s}*or{s}*(older|above|more)|>{s}*(89|90)|89\+"

_WORD = r"\p{L}\p{N}_"
_NUMBER = r"-?[0-9]+(?:\.[0-9]+)?"


def _number(value: Column) -> Column:
    """The first decimal number in a cell, a comma counting as the decimal point.

    Needs no blank test and no removal of unit words: blank spellings hold no digit, and a unit word that stands alone
    has no digit beside it.
    """
    digits = _replaced(ascii_digits(cell(value)), {",": "."})
    return F.regexp_substr(digits, F.lit(_NUMBER)).try_cast("double")


def _replaced(text: Column, swaps: Mapping[str, str]) -> Column:
    for old, new in swaps.items():
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def _integer(text: Column) -> Column:
    return F.regexp_substr(text, F.lit("[0-9]+")).try_cast("bigint")


def _without_words(value: Column, words: str) -> Column:
    """Lower-cased cell with whole words blanked out."""
    text = F.lower(ascii_digits(cell(value)))
    return F.regexp_replace(text, f"(?<![{_WORD}])(?:{words})(?![{_WORD}])", " ")


def _coded(text: Column, codes: Mapping[str, int]) -> Column:
    return F.coalesce(lookup(text, codes).cast("bigint"), _integer(text))


# --- stage / finish pairs ------------------------------------------------------------------------------------------


def _stage_sex(value: Column) -> dict[str, Column]:
    return {"token": F.rtrim(F.lower(strip(cell(value))), F.lit("."))}


def _finish_sex(staged: Mapping[str, Column]) -> dict[str, Column]:
    token = staged["token"]
    sex = F.when(one_of(token, MALE_TOKENS), "M").when(one_of(token, FEMALE_TOKENS), "F").otherwise("unknown")
    return {"value": sex}


def _stage_diagnosis(value: Column) -> dict[str, Column]:
    """Cleaned text without its qualifier; NULL when blank.

    One staged text serves both lookups: no whole-cell spelling starts with a qualifier and no phrase overlaps one.
    """
    spaced = F.lower(F.trim(single_spaced(cell(value))))
    text = _replaced(spaced, {"'": "", "’": ""})
    bare = F.regexp_replace(text, f"^(?:{'|'.join(DIAGNOSIS_QUALIFIERS)}) +", "")
    return {"text": F.when(~is_blank_spaced(cell(value), spaced), bare)}


def _finish_diagnosis(staged: Mapping[str, Column]) -> dict[str, Column]:
    text = staged["text"]
    whole = lookup(text, {token: label for label, tokens in DIAGNOSIS_TOKENS.items() for token in tokens})
    diagnosis = F.when(text.isNull(), "UNKNOWN").when(whole.isNotNull(), whole)
    for label, phrases in DIAGNOSIS_PHRASES:
        if label != "OTHER":  # what the last branch gives anyway
            diagnosis = diagnosis.when(_any([text.contains(phrase) for phrase in phrases]), label)
    return {"value": diagnosis.otherwise("OTHER")}


def _any(conditions: list[Column]) -> Column:
    hit = conditions[0]
    for condition in conditions[1:]:
        hit = hit | condition
    return hit


def _stage_age(value: Column) -> dict[str, Column]:
    pattern = CENSORED_AGE.replace("{s}", ANY_SPACE)
    return {"number": _number(value), "ceiling": F.coalesce(cell(value).rlike(pattern), F.lit(False))}


def _finish_age(staged: Mapping[str, Column]) -> dict[str, Column]:
    number = staged["number"]
    censored = staged["ceiling"] | F.coalesce(number > AGE_CAP, F.lit(False))
    return {"value": F.when(censored, F.lit(AGE_CAP)).otherwise(number), "censored": censored}


def _stage_braak(value: Column) -> dict[str, Column]:
    """Text before the first range mark, so that an uncertain stage reads as its first bound."""
    text = _replaced(_without_words(value, BRAAK_WORDS), {"&": "-", "/": "-", "to": "-"})
    text = F.btrim(single_spaced(text), F.lit(" .-"))
    return {"stage": F.rtrim(F.substring_index(_replaced(text, {" or ": "-"}), "-", 1))}


def _finish_braak(staged: Mapping[str, Column]) -> dict[str, Column]:
    return {"value": _coded(staged["stage"], ROMAN_STAGES)}


def _stage_cerad(value: Column) -> dict[str, Column]:
    return {"score": F.btrim(single_spaced(_without_words(value, CERAD_WORDS)), F.lit(" .-"))}


def _finish_cerad(staged: Mapping[str, Column]) -> dict[str, Column]:
    # "none" is a score here although it means "no value" elsewhere; the other blank spellings hold no digit.
    return {"value": _coded(staged["score"], CERAD_LABELS)}


def _stage_apoe(value: Column) -> dict[str, Column]:
    return {"alleles": F.regexp_replace(cell(value), "[^234]+", "")}


def _finish_apoe(staged: Mapping[str, Column]) -> dict[str, Column]:
    alleles = staged["alleles"]
    first, second = F.substring(alleles, 1, 1), F.substring(alleles, 2, 1)
    genotype = F.concat(F.lit("E"), F.least(first, second), F.lit("/E"), F.greatest(first, second))
    return {"value": F.when(F.char_length(alleles) == 2, genotype)}


def _stage_as_is(build: Callable[[Column], Column]) -> Callable[[Column], dict[str, Column]]:
    return lambda value: {"value": build(value)}


@dataclass(frozen=True)
class Normalizer:
    """How one kind of field is read: costly text work, then cheap branches on it."""

    stage: Callable[[Column], dict[str, Column]]
    finish: Callable[[Mapping[str, Column]], dict[str, Column]] = dict

    def __call__(self, value: Column) -> Column:
        """The normalized value as one expression, for ad-hoc use."""
        return self.finish(self.stage(value))["value"]


NORMALIZERS: dict[str, Normalizer] = {
    "text": Normalizer(_stage_as_is(normalize_text)),
    "sex": Normalizer(_stage_sex, _finish_sex),
    "diagnosis": Normalizer(_stage_diagnosis, _finish_diagnosis),
    "age": Normalizer(_stage_age, _finish_age),
    "braak": Normalizer(_stage_braak, _finish_braak),
    "cerad": Normalizer(_stage_cerad, _finish_cerad),
    "apoe": Normalizer(_stage_apoe, _finish_apoe),
    "float": Normalizer(_stage_as_is(_number)),
}

normalize_sex = NORMALIZERS["sex"]
normalize_diagnosis = NORMALIZERS["diagnosis"]
normalize_age = NORMALIZERS["age"]
normalize_braak = NORMALIZERS["braak"]
normalize_cerad = NORMALIZERS["cerad"]
normalize_apoe = NORMALIZERS["apoe"]
normalize_float = NORMALIZERS["float"]


def age_censored(value: Column) -> Column:
    """Whether an age cell is censored, either by its study or by the cap."""
    return normalize_age.finish(normalize_age.stage(value))["censored"]


# Fields per projection: what fits one method of generated code, which the JVM compiles up to 8,000 bytes.
_FIELDS_AT_ONCE = 4


def normalize_cells(
    frame: DataFrame, cells: Mapping[str, tuple[str, str]], keep: Sequence[str] = ()
) -> tuple[DataFrame, dict[str, dict[str, Column]]]:
    """Normalize ``{name: (raw column, kind)}`` over a table, a few fields per projection.

    Each projection finishes the fields that the one before staged, and stages the next ones. Gives the table, still
    carrying the ``keep`` columns, and the output columns to select from it by name and part.
    """
    names = list(cells)
    outputs: dict[str, dict[str, Column]] = {}
    carried = [F.col(name) for name in keep]
    pending: dict[str, Column] = {}
    for at in range(0, len(names), _FIELDS_AT_ONCE):
        group, later = names[at : at + _FIELDS_AT_ONCE], names[at + _FIELDS_AT_ONCE :]
        staged: dict[str, Column] = {}
        finishing: dict[str, Column] = {}
        for name in group:
            raw, kind = cells[name]
            parts = NORMALIZERS[kind].stage(F.col(raw))
            staged |= {_part(name, part, "s"): expr.alias(_part(name, part, "s")) for part, expr in parts.items()}
            finished = NORMALIZERS[kind].finish({part: F.col(_part(name, part, "s")) for part in parts})
            finishing |= {_part(name, part, "v"): expr.alias(_part(name, part, "v")) for part, expr in finished.items()}
            outputs[name] = {part: F.col(_part(name, part, "v")) for part in finished}
        raws = {cells[name][0] for name in later} - set(keep)
        given = frame.select(*carried, *pending.values(), *(F.col(raw) for raw in sorted(raws)), *staged.values())
        frame = bound(given, [*pending, *staged])
        carried += [F.col(alias) for alias in pending]
        pending = finishing
    return frame.select(*carried, *pending.values()), outputs


def _part(name: str, part: str, step: str) -> str:
    return f"__{step}_{name}_{part}"


def normalize_columns(
    kinds: Mapping[str, str], where: Column | str | None = None
) -> Callable[[DataFrame], DataFrame]:
    """``df.transform(normalize_columns({"age": "age", "dx": "diagnosis"}))``: normalize columns in place.

    Other columns pass through, and so do filters on them that are put on the result: they reach the scan, and rows that
    they drop are never normalized. Filters on a normalized column read what was normalized once. ``where`` is a filter on
    the columns as given, for conditions on raw cells. An age column also gives ``<column>_censored``, right after it.
    """

    def transform(frame: DataFrame) -> DataFrame:
        absent = sorted(set(kinds) - set(frame.columns))
        if absent:
            raise KeyError(f"Columns not in the table: {absent}")
        plain = {name: f"_{i}" for i, name in enumerate(frame.columns)}
        keep = [alias for name, alias in plain.items() if name not in kinds]
        cells = {plain[name]: (plain[name], kind) for name, kind in kinds.items()}
        given = frame if where is None else frame.where(where)
        table, finished = normalize_cells(given.toDF(*plain.values()), cells, keep)
        output: list[Column] = []
        for name, alias in plain.items():
            parts = finished.get(alias, {"value": F.col(alias)})
            output += [expr.alias(name if part == "value" else f"{name}_{part}") for part, expr in parts.items()]
        return table.select(*output)

    return transform
