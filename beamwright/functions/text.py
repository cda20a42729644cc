"""Text and record functions: every one maps columns to a column."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from beamwright import fixed

# Unicode white space plus the separators U+001C..U+001F, quotes and commas
_EDGE = r"""["'\s\x1c-\x1f,]+"""


def clean_email(raw: Column, unknown: str = fixed.UNKNOWN_EMAIL) -> Column:
    """Usable address or ``unknown``; edges stripped, inner spaces dropped."""
    bare = F.regexp_replace(raw, f"(?U)^{_EDGE}|{_EDGE}$", "")
    bad = bare.isNull() | (bare == "") | (F.upper(bare) == "NONE") | ~bare.contains("@")
    return F.when(bad, F.lit(unknown)).otherwise(F.replace(bare, F.lit(" "), F.lit("")))


def keywords(name: Column) -> Column:
    """Lower-case alphanumeric runs in order, duplicates kept."""
    parts = F.split(F.coalesce(name, F.lit("")), "[^a-zA-Z0-9]")
    return F.transform(F.filter(parts, lambda t: F.length(t) > 0), F.lower)


def search_terms(name: Column) -> Column:
    return F.array_join(keywords(name), " ")


def access_controls(user: Column, beamline: Column, proposal: Column) -> Column:
    """struct(owner_group, access_groups) from the scan's own metadata."""
    line = F.replace(F.replace(beamline, F.lit(" '"), F.lit("")), F.lit("', "), F.lit(""))
    groups = F.array(line, user)
    for source, extra in fixed.BEAMLINE_ALIASES.items():
        missing = (line == source) & ~F.array_contains(groups, extra)
        groups = F.when(missing, F.array_append(groups, F.lit(extra))).otherwise(groups)
    none = F.array().cast("array<string>")
    has_line = F.coalesce(line != "", F.lit(False))
    has_proposal = F.coalesce((proposal != "") & (proposal != "None"), F.lit(False))
    return F.struct(
        F.when(has_proposal, proposal).otherwise(user).alias("owner_group"),
        F.when(has_line, groups).otherwise(none).alias("access_groups"),
    )


def typed_literal(raw: Column) -> Column:
    """struct(type, int_value, float_value, str_value): integer, float, else text."""
    s = F.trim(raw)
    # most words start with a letter no number starts with: no pattern is run on those
    maybe = F.instr(F.lit("0123456789+-.nNiI"), F.substring(s, 1, 1)) > 0
    whole = F.when(maybe & s.rlike(r"^[+-]?\d+\z"), s.try_cast("bigint"))
    number = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\z|(?i)^[+-]?(nan|inf|infinity)\z"
    real = F.when(maybe & whole.isNull() & s.rlike(number), s.try_cast("double"))
    kind = F.when(whole.isNotNull(), "int").when(real.isNotNull(), "float")
    return F.struct(
        F.coalesce(kind, F.lit("str")).alias("type"),
        whole.alias("int_value"),
        real.alias("float_value"),
        F.when(kind.isNull(), raw).alias("str_value"),
    )


def _words(line: Column) -> Column:
    return F.filter(F.split(line, r"\s+"), lambda w: F.length(w) > 0)


def spec_filename(line: Column) -> Column:
    return F.get(_words(line), 0)


def spec_map(line: Column) -> Column:
    """name -> list of raw values; a later duplicate of a name wins."""
    words = _words(line)
    pairs = F.floor((F.size(words) - 1) / 2).cast("int")
    names = F.transform(
        F.filter(F.sequence(F.lit(0), F.greatest(pairs, F.lit(1))), lambda i: i < pairs),
        lambda i: F.struct(
            F.get(words, i * 2 + 1).alias("k"),
            F.split(F.replace(F.get(words, i * 2 + 2), F.lit('"'), F.lit("")), ",").alias("v"),
            i.alias("i"),
        ),
    )
    last = F.filter(
        names,
        lambda e: ~F.exists(names, lambda o: (o["k"] == e["k"]) & (o["i"] > e["i"])),
    )
    return F.map_from_entries(F.transform(last, lambda e: F.struct(e["k"], e["v"])))


def overlay_params(defaults: dict, overrides: Column) -> Column:
    """Defaults, updated only for names they already hold; unknown names vanish."""
    pairs = []
    for name, value in defaults.items():
        given = F.map_contains_key(overrides, F.lit(name))
        pairs += [F.lit(name), F.when(given, overrides[name]).otherwise(F.lit(value))]
    return F.create_map(*pairs)


def extract_job_id(message: Column) -> Column:
    return F.nullif(F.regexp_extract(message, r"Job not found:\s*(\d+)", 1), F.lit(""))


def data_uri(payload: Column, kind: str = "jpg") -> Column:
    """Data URI on one line (Spark breaks base64 text into lines of 76)."""
    return F.concat(F.lit(f"data:image/{kind};base64,"), F.translate(F.base64(payload), "\r\n", ""))


def expand_variables(text: Column, env: dict) -> Column:
    """``$NAME`` and ``${NAME}`` replaced for known names, others left as they are."""
    for name, value in env.items():
        safe = value.replace("\\", "\\\\").replace("$", "\\$")
        text = F.regexp_replace(text, rf"\$(\{{{name}\}}|{name}(?![A-Za-z0-9_]))", safe)
    return text


def params_for(flow: Column, available: Column, allowed: dict = fixed.FLOW_PARAMETERS) -> Column:
    """Only the available parameters that the flow accepts; null for an unknown flow."""
    lists = F.create_map(*[x for k, v in allowed.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    names = lists[flow]
    return F.when(names.isNotNull(), F.map_filter(available, lambda k, _: F.array_contains(names, k)))
