"""The catalogue's queries as DuckDB SQL, written from the definitions rather than from the Spark expressions.

Where the Spark side merges steps (one staged diagnosis text, no blank test before a number), the SQL keeps them apart,
so that a comparison tests the merging too.
"""

from __future__ import annotations

from cohortloom.plans.cohorts import COHORTS, OUTLIER_ID, OUTLIER_KEY

# The input cohorts are shared: both sides must read the same rows. All else is spelled out again here, so that a slip in
# the engine's tables shows.

# The canonical columns and their types, and what each study's columns become.
CANONICAL = {
    "sample_id": "VARCHAR",
    "source_study": "VARCHAR",
    "subject_id": "VARCHAR",
    "age_years": "DOUBLE",
    "age_censored": "BOOLEAN",
    "sex": "VARCHAR",
    "diagnosis": "VARCHAR",
    "braak_stage": "BIGINT",
    "cerad_score": "BIGINT",
    "apoe_genotype": "VARCHAR",
    "brain_region": "VARCHAR",
    "platform": "VARCHAR",
    "rin": "DOUBLE",
    "pmi_hours": "DOUBLE",
    "batch": "VARCHAR",
}
KINDS = {
    "age_years": "age",
    "sex": "sex",
    "diagnosis": "diagnosis",
    "braak_stage": "braak",
    "cerad_score": "cerad",
    "apoe_genotype": "apoe",
    "rin": "float",
    "pmi_hours": "float",
}
CROSSWALKS = {
    "GSE5281": {
        "geo_accession": "sample_id",
        "subject": "subject_id",
        "age": "age_years",
        "sex": "sex",
        "disease_state": "diagnosis",
        "region": "brain_region",
        "apoe": "apoe_genotype",
    },
    "GSE33000": {
        "sample": "sample_id",
        "donor_id": "subject_id",
        "age_at_death": "age_years",
        "gender": "sex",
        "dx": "diagnosis",
        "braak": "braak_stage",
        "tissue": "brain_region",
        "pmi": "pmi_hours",
        "scan_batch": "batch",
    },
    "GSE125583": {
        "title": "sample_id",
        "patient": "subject_id",
        "age": "age_years",
        "Sex": "sex",
        "diagnosis": "diagnosis",
        "braak_stage": "braak_stage",
        "cerad": "cerad_score",
        "apoe_genotype": "apoe_genotype",
        "brain_region": "brain_region",
        "rin": "rin",
        "pmi_hrs": "pmi_hours",
        "seq_batch": "batch",
    },
}
PLATFORMS = {
    "GSE5281": "Affymetrix HG-U133 Plus 2.0",
    "GSE33000": "Rosetta/Merck Human 44k",
    "GSE125583": "Illumina HiSeq 2500",
}
NOTES = {
    "GSE5281": "Microarray without neuropathology: Braak stage and CERAD score stay null.",
    "GSE33000": (
        "Ages end at '90+' (Safe Harbor): capped at 90 and marked censored. Braak stage in Roman numerals."
    ),
    "GSE125583": "CERAD score in words, APOE genotype as two bare digits.",
}
FILES = {
    "GSE5281": "GSE5281_metadata.csv",
    "GSE33000": "GSE33000_metadata.csv",
    "GSE125583": "GSE125583_metadata.csv",
}
# Spellings.
BLANK_TOKENS = ["", "-", "--", ".", "n/a", "na", "nan", "none", "null", "missing", "unknown", "unk", "not reported"]
BLANK_TOKENS += ["not available", "not applicable", "no data"]
MALE_TOKENS = ["m", "male", "1", "man", "xy"]
FEMALE_TOKENS = ["f", "female", "2", "woman", "xx"]
DIAGNOSIS_TOKENS = {
    "AD": ["ad", "load", "eoad"],
    "MCI": ["mci", "ci"],
    "CONTROL": ["control", "controls", "ctrl", "ctl", "nc", "hc", "normal", "healthy", "unaffected"],
}
DIAGNOSIS_PHRASES = [
    ("MCI", ["mild cognitive impairment", "cognitive impairment"]),
    ("AD", ["alzheimer"]),
    ("CONTROL", ["non-demented", "nondemented", "no dementia", "cognitively normal", "cognitively unimpaired"]),
    ("CONTROL", ["healthy control"]),
    ("OTHER", ["frontotemporal", "lewy", "vascular dementia", "parkinson", "progressive supranuclear", "dementia"]),
]
SPACES = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)]))
SPACES += "".join(map(chr, [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
# The rules in their order, what rejects a row and what flags it.
REJECTS = ["missing_sample_id", "missing_source_study", "missing_diagnosis", "duplicate_sample_id"]
REJECTS += ["diagnosis_not_recognized", "age_out_of_range", "braak_out_of_range", "cerad_out_of_range"]
REJECTS += ["rin_out_of_range", "pmi_out_of_range"]
FLAG_NAMES = ["ad_without_pathology", "control_with_pathology", "degraded_rna", "implausibly_young", "missing_age"]
RULE_NAMES = [*REJECTS, *FLAG_NAMES]
# What the catalogue's queries look at.
RAW_FIELDS = {
    "sex": {"GSE5281": "sex", "GSE33000": "gender", "GSE125583": "Sex"},
    "diagnosis": {"GSE5281": "disease_state", "GSE33000": "dx", "GSE125583": "diagnosis"},
    "age": {"GSE5281": "age", "GSE33000": "age_at_death", "GSE125583": "age"},
    "braak": {"GSE33000": "braak", "GSE125583": "braak_stage"},
    "cerad": {"GSE125583": "cerad"},
    "apoe": {"GSE5281": "apoe", "GSE125583": "apoe_genotype"},
    "float": {"GSE33000": "pmi", "GSE125583": "rin"},
}
TABLE_KINDS = {
    "title": "text",
    "age": "age",
    "Sex": "sex",
    "diagnosis": "diagnosis",
    "braak_stage": "braak",
    "cerad": "cerad",
    "apoe_genotype": "apoe",
    "brain_region": "text",
    "rin": "float",
    "pmi_hrs": "float",
}
RULE_GROUPS = {
    "rule_missing_required": REJECTS[:3],
    "rule_vocabulary": ["diagnosis_not_recognized"],
    "rule_ranges": REJECTS[5:],
    "rule_flags": FLAG_NAMES,
}
# Rows of line items that break the rules; how often each value comes is up to the factor.
OUTLIERS = {
    "source_study": ("VARCHAR", 1, ["GSE5281", "GSE33000", None, "", "GSE125583"]),
    "diagnosis": ("VARCHAR", 3, ["AD", "MCI", "CONTROL", "OTHER", "UNKNOWN", "not-a-real-dx", None, " "]),
    "age_years": ("DOUBLE", 7, ["80", "200", "0", "120", "120.5", "-1", "12", "39.5", None, "NaN", "40"]),
    "braak_stage": ("BIGINT", 4, ["0", "1", "6", "7", "5", None, "9", "-1", "3"]),
    "cerad_score": ("BIGINT", 3, ["0", "3", "4", None, "-1"]),
    "rin": ("DOUBLE", 7, ["1", "10", "10.5", "4.5", "5", None, "NaN", "0.5", "8"]),
    "pmi_hours": ("DOUBLE", 5, ["0", "120", "120.5", None, "500", "-0.5", "NaN"]),
}

NUMBER = r"-?\d+(?:\.\d+)?"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def texts(values) -> str:
    return ", ".join(map(text, values))


def quoted(name: str) -> str:
    return f'"{name}"'


SPACE = f"[{''.join(f'\\x{{{ord(c):x}}}' for c in SPACES)}]"


def strip(v: str) -> str:
    return f"trim({v}, {text(SPACES)})"


def low(v: str) -> str:
    return f"lower({strip(v)})"


def squeeze(v: str) -> str:
    return f"regexp_replace({v}, '{SPACE}+', ' ', 'g')"


def blank(v: str) -> str:
    return f"({v} IS NULL OR {low(v)} IN ({texts(BLANK_TOKENS)}))"


def first(v: str, pattern: str) -> str:
    return f"nullif(regexp_extract({v}, '{pattern}'), '')"


def normalize_text(v: str) -> str:
    return f"CASE WHEN {blank(v)} THEN NULL ELSE {strip(squeeze(v))} END"


def normalize_sex(v: str) -> str:
    token = f"regexp_replace({low(v)}, '\\.+$', '')"
    return (
        f"CASE WHEN {blank(v)} THEN 'unknown' WHEN {token} IN ({texts(MALE_TOKENS)}) THEN 'M' "
        f"WHEN {token} IN ({texts(FEMALE_TOKENS)}) THEN 'F' ELSE 'unknown' END"
    )


def normalize_diagnosis(v: str) -> str:
    cleaned = f"replace(replace({squeeze(low(v))}, '''', ''), '’', '')"
    bare = f"regexp_replace({cleaned}, '^(probable|definite|possible|suspected)\\s+', '')"
    branches = [f"WHEN {blank(v)} THEN 'UNKNOWN'"]
    for form in (cleaned, bare):
        branches += [f"WHEN {form} IN ({texts(tokens)}) THEN '{label}'" for label, tokens in DIAGNOSIS_TOKENS.items()]
    for label, phrases in DIAGNOSIS_PHRASES:
        branches += [f"WHEN contains({cleaned}, {text(phrase)}) THEN '{label}'" for phrase in phrases]
    return f"CASE {' '.join(branches)} ELSE 'OTHER' END"


def _age(v: str) -> tuple[str, str, str]:
    ceiling = (
        f"regexp_matches({low(v)}, '90{SPACE}*\\+|90{SPACE}*or{SPACE}*(older|above|more)|>{SPACE}*(89|90)|89\\+')"
    )
    units = f"regexp_replace({low(v)}, '\\b(years?|yrs?|y/?o)\\b', '', 'g')"
    return blank(v), ceiling, f"try_cast({first(f"replace({units}, ',', '.')", NUMBER)} AS DOUBLE)"


def normalize_age(v: str) -> str:
    is_blank, ceiling, number = _age(v)
    return (
        f"CASE WHEN {is_blank} THEN NULL WHEN {ceiling} THEN 90.0::DOUBLE WHEN {number} > 90 THEN 90.0::DOUBLE "
        f"ELSE {number} END"
    )


def age_censored(v: str) -> str:
    is_blank, ceiling, number = _age(v)
    return f"CASE WHEN {is_blank} THEN false WHEN {ceiling} THEN true ELSE coalesce({number} > 90, false) END"


def _coded(v: str, codes: dict[str, int]) -> str:
    labels = " ".join(f"WHEN {v} = '{label}' THEN {code}" for label, code in codes.items())
    return f"CAST(CASE {labels} ELSE try_cast({first(v, r'\d+')} AS BIGINT) END AS BIGINT)"


def normalize_braak(v: str) -> str:
    words = f"regexp_replace({low(v)}, '\\b(braak|stage|nft|score)\\b', ' ', 'g')"
    dashed = f"replace(replace(replace({words}, '&', '-'), '/', '-'), 'to', '-')"
    bound = f"trim(string_split_regex(trim({squeeze(dashed)}, ' .-'), '\\s*-\\s*|\\s+or\\s+')[1])"
    return f"CASE WHEN {blank(v)} THEN NULL ELSE {_coded(bound, {'0': 0, 'i': 1, 'ii': 2, 'iii': 3, 'iv': 4, 'v': 5, 'vi': 6})} END"


def normalize_cerad(v: str) -> str:
    words = f"regexp_replace({low(v)}, '\\b(cerad|score|plaques?|neuritic)\\b', ' ', 'g')"
    labels = {"none": 0, "zero": 0, "sparse": 1, "mild": 1, "moderate": 2, "frequent": 3, "severe": 3}
    return _coded(f"trim({squeeze(words)}, ' .-')", labels)


def normalize_apoe(v: str) -> str:
    alleles = f"list_sort(regexp_extract_all({v}, '[234]'))"
    return (
        f"CASE WHEN {blank(v)} THEN NULL WHEN len({alleles}) = 2 "
        f"THEN concat('E', {alleles}[1], '/E', {alleles}[2]) END"
    )


def normalize_float(v: str) -> str:
    units = f"regexp_replace({low(v)}, '\\b(hours?|hrs?|h)\\b', '', 'g')"
    number = f"try_cast({first(f"replace({units}, ',', '.')", NUMBER)} AS DOUBLE)"
    return f"CASE WHEN {blank(v)} THEN NULL ELSE {number} END"


BUILDERS = {
    "text": normalize_text,
    "sex": normalize_sex,
    "diagnosis": normalize_diagnosis,
    "age": normalize_age,
    "braak": normalize_braak,
    "cerad": normalize_cerad,
    "apoe": normalize_apoe,
    "float": normalize_float,
}


# --- input tables --------------------------------------------------------------------------------------------------


def pick(factor: int, words: list[str | None]) -> str:
    listed = ", ".join("NULL" if word is None else text(word) for word in words)
    return f"list_extract([{listed}], 1 + ({factor} * k) % {len(words)})"


def ansi(expression: str) -> str:
    return expression.replace(" DIV ", " // ")


def cohort(study: str) -> str:
    source, key, columns = COHORTS[study]
    cells = ", ".join(
        f"{ansi(spec) if isinstance(spec, str) else pick(*spec)} AS {quoted(name)}" for name, spec in columns.items()
    )
    return f"SELECT {cells} FROM (SELECT *, {key} AS k FROM {source})"


def harmonized(study: str, absent: tuple[str, ...] = ()) -> str:
    source_of = {field: source for source, field in CROSSWALKS[study].items()}
    cells = []
    for name, dtype in CANONICAL.items():
        source, age = source_of.get(name), source_of["age_years"]
        if name == "source_study":
            value = text(study)
        elif name == "age_censored":
            value = "false" if age in absent else age_censored(quoted(age))
        elif name == "platform":
            value = text(PLATFORMS[study])
        elif source is None or source in absent:
            value = "NULL"
        else:
            value = BUILDERS[KINDS.get(name, "text")](quoted(source))
        cells.append(f"CAST({value} AS {dtype}) AS {name}")
    return f"SELECT {', '.join(cells)} FROM ({cohort(study)})"


def union() -> str:
    return " UNION ALL ".join(f"SELECT * FROM ({harmonized(study)})" for study in COHORTS)


def outliers() -> str:
    cells = ", ".join(
        f"CAST({pick(factor, words)} AS {dtype}) AS {name}"
        for name, (dtype, factor, words) in OUTLIERS.items()
    )
    return f"SELECT {OUTLIER_ID} AS sample_id, {cells} FROM (SELECT *, {OUTLIER_KEY} AS k FROM lineitem)"


def mixed() -> str:
    columns = ", ".join(["sample_id", *OUTLIERS])
    return f"SELECT {columns} FROM ({union()}) UNION ALL SELECT {columns} FROM ({outliers()})"


# --- rules ---------------------------------------------------------------------------------------------------------


def _number(name: str) -> str:
    return f"CASE WHEN isnan({name}) THEN NULL ELSE {name} END" if name in ("age_years", "rin", "pmi_hours") else name


def _predicates() -> dict[str, str]:
    age, rin = (f"({_number(name)})" for name in ("age_years", "rin"))
    predicates = {
        f"missing_{name}": f"{name} IS NULL OR {strip(name)} = ''" for name in ("sample_id", "source_study", "diagnosis")
    }
    predicates["duplicate_sample_id"] = "sample_id IS NOT NULL AND count(*) OVER (PARTITION BY sample_id) > 1"
    predicates["diagnosis_not_recognized"] = f"diagnosis IS NOT NULL AND diagnosis NOT IN ('AD', 'MCI', 'CONTROL', 'OTHER', 'UNKNOWN')"
    for rule, name, lowest, highest in (
        ("age_out_of_range", "age_years", 0, 120),
        ("braak_out_of_range", "braak_stage", 0, 6),
        ("cerad_out_of_range", "cerad_score", 0, 3),
        ("rin_out_of_range", "rin", 1, 10),
        ("pmi_out_of_range", "pmi_hours", 0, 120),
    ):
        predicates[rule] = f"({_number(name)}) < {lowest} OR ({_number(name)}) > {highest}"
    predicates["ad_without_pathology"] = "diagnosis = 'AD' AND braak_stage <= 1"
    predicates["control_with_pathology"] = "diagnosis = 'CONTROL' AND braak_stage >= 5"
    predicates["degraded_rna"] = f"{rin} < 5"
    predicates["implausibly_young"] = f"{age} < 40"
    predicates["missing_age"] = f"{age} IS NULL"
    return predicates


PREDICATES = _predicates()


def judged(batch: str, names: tuple[str, ...] = tuple(RULE_NAMES)) -> str:
    """The batch with a boolean per rule, the verdict, the reasons and the flags."""
    masks = ", ".join(f"coalesce({PREDICATES[name]}, false) AS {name}" for name in names)

    def joined(wanted: list[str]) -> str:
        hits = [f"CASE WHEN {name} THEN '{name}' END" for name in sorted(names) if name in wanted]
        return f"concat_ws(';', {', '.join(hits)})"

    rejects = " OR ".join(name for name in names if name in REJECTS)
    return (
        f"SELECT *, ({rejects}) AS rejected, {joined(REJECTS)} AS quarantine_reason, "
        f"{joined(FLAG_NAMES)} AS quality_flags FROM (SELECT *, {masks} FROM ({batch}))"
    )


def masks(names: tuple[str, ...]) -> str:
    return f"SELECT sample_id, {', '.join(names)} FROM ({judged(mixed())})"


def silver() -> str:
    return f"SELECT {', '.join(CANONICAL)}, quality_flags FROM ({judged(union())}) WHERE NOT rejected"


def counts(batch: str) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) FILTER (WHERE {name}) AS failures FROM judged" for name in RULE_NAMES
    )
    return f"WITH judged AS ({judged(batch)}) {rows}"


def rates() -> str:
    return (
        "SELECT count(*) AS total, count(*) FILTER (WHERE NOT rejected) AS clean, "
        "count(*) FILTER (WHERE rejected) AS quarantined, "
        "CASE WHEN count(*) = 0 THEN 1.0::DOUBLE "
        "ELSE count(*) FILTER (WHERE NOT rejected)::DOUBLE / count(*)::DOUBLE END AS pass_rate "
        f"FROM ({judged(union())})"
    )


# --- per query -----------------------------------------------------------------------------------------------------


def _field_sql(kind: str) -> str:
    selects = []
    for study, column in RAW_FIELDS[kind].items():
        sample, raw = quoted(next(iter(CROSSWALKS[study]))), quoted(column)
        censored = f", {age_censored(raw)} AS value_censored" if kind == "age" else ""
        selects.append(
            f"SELECT '{study}' AS study_id, {sample} AS sample, {raw} AS raw, {BUILDERS[kind](raw)} AS value{censored} "
            f"FROM ({cohort(study)})"
        )
    return " UNION ALL ".join(selects)


def _table_sql() -> str:
    cells = []
    for name in COHORTS["GSE125583"][2]:
        kind = TABLE_KINDS.get(name)
        cells.append(f"{BUILDERS[kind](quoted(name)) if kind else quoted(name)} AS {quoted(name)}")
        if kind == "age":
            cells.append(f"{age_censored(quoted(name))} AS {name}_censored")
    return f"SELECT {', '.join(cells)} FROM ({cohort('GSE125583')})"


def _blank_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT '{study}' AS study_id, '{name}' AS column_name, count(*) FILTER (WHERE {blank(quoted(name))}) AS blanks "
        f"FROM ({cohort(study)})"
        for study in ("GSE5281", "GSE33000")
        for name in COHORTS[study][2]
    )


def _audit_sql() -> str:
    renamed = {"pmi": "post_mortem", "dx": "DX"}
    delivered, expected = [], []
    for study, (source, _, columns) in COHORTS.items():
        names = [renamed.get(name, name) if study == "GSE33000" else name for name in columns]
        names += ["scanner_model"] if study == "GSE5281" else []
        # The third delivery is a header without rows.
        rows = "(SELECT 1)" if study == "GSE125583" else source
        delivered.append(
            f"SELECT DISTINCT '{study}' AS study_id, c.name AS column_name "
            f"FROM {rows}, (SELECT unnest([{texts(names)}]) AS name) AS c"
        )
        expected.append(f"SELECT '{study}' AS study_id, unnest([{texts(sorted(CROSSWALKS[study]))}]) AS column_name")
    sides = {
        "matched": "came AND wanted",
        "missing": "wanted AND NOT came",
        "unmapped": "came AND NOT wanted",
    }
    lists = ", ".join(
        f"coalesce(string_agg(column_name, ',' ORDER BY column_name) FILTER (WHERE {side}), '') AS {name}"
        for name, side in sides.items()
    )
    sizes = ", ".join(f"count(*) FILTER (WHERE {side}) AS n_{name}" for name, side in sides.items())
    return (
        f"WITH delivered AS ({' UNION ALL '.join(delivered)}), expected AS ({' UNION ALL '.join(expected)}), "
        "pairs AS (SELECT study_id, column_name, d.study_id IS NOT NULL AS came, e.study_id IS NOT NULL AS wanted "
        "FROM delivered AS d FULL JOIN expected AS e USING (study_id, column_name)), "
        f"audit AS (SELECT study_id, {lists}, {sizes} FROM pairs GROUP BY study_id) "
        "SELECT study_id, matched, missing, unmapped, n_missing = 0 AS is_complete, "
        "concat(study_id, ': ', n_matched, ' mapped, ', n_missing, ' missing [', "
        "CASE WHEN n_missing > 0 THEN concat('''', replace(missing, ',', ''', '''), '''') ELSE '' END, "
        "'], ', n_unmapped, ' source columns unused') AS summary FROM audit"
    )


def _flagship_sql() -> str:
    flags = ", ".join(f"count(*) FILTER (WHERE {name}) AS {name}" for name in FLAG_NAMES)
    return (
        "SELECT source_study, diagnosis, count(*) AS samples, count(*) FILTER (WHERE age_censored) AS censored_ages, "
        "min(age_years) AS youngest, max(age_years) AS oldest, max(braak_stage) AS highest_stage, "
        f"count(apoe_genotype) AS genotyped, {flags} FROM ({judged(union())}) WHERE NOT rejected GROUP BY ALL"
    )


def _manifest_sql() -> str:
    fixed = {
        "run_id": "0012",
        "studies": "GSE125583,GSE33000,GSE5281",
        "is_timed": "true",
        "silver_path": "silver/samples/run_id=0012",
        "quarantine_path": "quarantine/samples/run_id=0012",
        **{f"source_paths:{study}": path for study, path in FILES.items()},
        **{f"mapping_notes:{study}": note for study, note in NOTES.items()},
        **{
            f"mapping_audit:{study}": f"{study}: {len(columns)} mapped, 0 missing [], 0 source columns unused"
            for study, columns in CROSSWALKS.items()
        },
    }
    counted = {
        "rows_in": "true",
        "rows_clean": "NOT rejected",
        "rows_quarantined": "rejected",
        **{f"rule_counts:{name}": name for name in RULE_NAMES},
    }
    rows = [f"SELECT {text(name)} AS measure, {text(value)} AS value" for name, value in fixed.items()]
    rows += [
        f"SELECT {text(name)}, CAST(count(*) FILTER (WHERE {condition}) AS VARCHAR) FROM judged"
        for name, condition in counted.items()
    ]
    return f"WITH judged AS ({judged(union())}) {' UNION ALL '.join(rows)}"


def _inventory_sql() -> str:
    rows = []
    for prefix in ("", "GSE33000_m"):
        names = [f"{file}/{name}" for file in sorted(FILES.values()) for name in ("_SUCCESS", "part-00000.csv")]
        for position, path in enumerate(name for name in names if name.startswith(prefix)):
            has_bytes = not path.endswith("_SUCCESS")
            rows.append(f"({text(prefix)}, {position}, {text(path)}, {has_bytes})")
    return f"SELECT * FROM (VALUES {', '.join(rows)}) AS v(prefix, position, path, has_bytes)"


def _bronze_sql() -> str:
    cells = ", ".join(f"nullif({quoted(name)}, '') AS {quoted(name)}" for name in COHORTS["GSE33000"][2])
    return f"SELECT {cells} FROM ({cohort('GSE33000')})"


def sql() -> dict[str, str]:
    canonical = ", ".join(CANONICAL)
    empty = f"SELECT * FROM ({harmonized('GSE5281')}) WHERE sample_id IS NULL"
    return {
        "flagship_summary": _flagship_sql(),
        "bronze_scan": _bronze_sql(),
        "bronze_scan_multiline": (
            "SELECT CAST(doc_id AS VARCHAR) AS doc_id, nullif(text, '') AS text, lang FROM documents"
        ),
        "layer_inventory": _inventory_sql(),
        "is_blank_profile": _blank_sql(),
        "normalize_text": f"SELECT doc_id, {normalize_text('text')} AS text FROM documents",
        **{f"normalize_{kind}": _field_sql(kind) for kind in RAW_FIELDS},
        "normalize_table": _table_sql(),
        "harmonize_cohort_a": harmonized("GSE5281"),
        "harmonize_cohort_b": harmonized("GSE33000"),
        "harmonize_cohort_c": harmonized("GSE125583"),
        "harmonize_missing_column": harmonized("GSE5281", absent=("age", "sex", "disease_state")),
        "harmonize_union": union(),
        "harmonize_empty_union": harmonized("GSE5281"),
        "mapping_audit": _audit_sql(),
        "unmapped_studies": (
            "SELECT DISTINCT study_id FROM (SELECT list_extract(['GSE5281', 'STUDY-X1', 'GSE33000', 'GSE125583', "
            "'STUDY-X2'], 1 + o_orderkey % 5) AS study_id FROM orders) "
            "WHERE study_id NOT IN ('GSE5281', 'GSE33000', 'GSE125583')"
        ),
        "rule_masks": masks(tuple(PREDICATES)),
        **{name: masks(tuple(rules)) for name, rules in RULE_GROUPS.items()},
        "rule_duplicate_sample_id": (
            "SELECT sample_id, l_partkey, count(*) OVER (PARTITION BY sample_id) > 1 AS is_duplicate "
            "FROM (SELECT concat(l_orderkey, '_', l_linenumber) AS sample_id, l_partkey FROM lineitem)"
        ),
        "rule_duplicate_split": (
            "SELECT sample_id, l_partkey, sample_id IS NOT NULL AND count(*) OVER (PARTITION BY sample_id) > 1 "
            "AS is_duplicate FROM (SELECT CASE WHEN l_partkey % 10 = 0 THEN 'many' WHEN l_partkey % 11 <> 0 "
            "THEN concat(l_orderkey, '_', l_linenumber) END AS sample_id, l_partkey FROM lineitem)"
        ),
        "validate_split": (
            "SELECT sample_id, source_study, CASE WHEN rejected THEN 'quarantine' ELSE 'silver' END AS layer, "
            f"CASE WHEN rejected THEN quarantine_reason ELSE quality_flags END AS detail FROM ({judged(mixed())})"
        ),
        "validate_reasons": (
            f"SELECT quarantine_reason, count(*) AS samples FROM ({judged(mixed())}) WHERE rejected GROUP BY ALL"
        ),
        "validate_rule_subset": (
            f"SELECT sample_id, diagnosis, quality_flags FROM ({judged(mixed(), ('braak_out_of_range', 'degraded_rna', 'missing_age'))}) WHERE NOT rejected"
        ),
        "validate_empty": counts(empty),
        "rule_counts": counts(mixed()),
        "pass_rate": rates(),
        "quality_gate": f"SELECT pass_rate, pass_rate >= 0.95 AS passed FROM ({rates()})",
        "diagnosis_counts": f"SELECT diagnosis, count(*) AS samples FROM ({silver()}) GROUP BY diagnosis",
        "flagged_samples": (
            f"SELECT sample_id, source_study, rin, quality_flags FROM ({silver()}) "
            "WHERE list_contains(string_split(quality_flags, ';'), 'degraded_rna')"
        ),
        "distinct_vocab": f"SELECT DISTINCT source_study, diagnosis, sex FROM ({silver()})",
        "silver_roundtrip": f"SELECT *, '0012' AS run_id FROM ({silver()})",
        "quarantine_roundtrip": (
            f"SELECT {canonical}, quarantine_reason, '0012' AS run_id FROM ({judged(union())}) WHERE rejected"
        ),
        "run_manifest": _manifest_sql(),
    }
