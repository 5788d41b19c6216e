"""Column functions on text: rendering, parsing and normal forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: words that mark the phase of a step, first rule first
PHASES = [("place", "place|put|drop|release|insert|pour"), ("grasp", "grasp|grab|pick|lift|hold"), ("approach", "approach|reach|move|go"), ("interact", "open|close|turn|push|pull|press|wipe")]
STOP_WORDS = ["a", "an", "the", "of", "to", "in", "on", "and", "it", "is", "from", "with", "by", "for"]


def describe_move(v: Column) -> Column:
    """Seven numbers (metres, radians, gripper) as a sentence; zero reads as the negative word."""
    g = lambda i: F.element_at(v, i)
    whole = lambda x: F.bround(F.abs(x)).cast("long").cast("string")
    step = lambda i, name, up, down, unit: F.concat(F.lit(f"{name} "), F.when(g(i) > 0, up).otherwise(down), F.lit(" "), whole(g(i) * 1000 if unit == "mm" else F.degrees(g(i))), F.lit(f" {unit}; "))
    return F.concat(
        step(1, "move", "forward", "backward", "mm"), step(2, "move", "left", "right", "mm"), step(3, "move", "upward", "downward", "mm"),
        step(4, "roll", "upward", "downward", "degrees"), step(5, "pitch", "upward", "downward", "degrees"), step(6, "yaw", "counterclockwise", "clockwise", "degrees"),
        F.when(g(7) > 0.5, "open gripper;").otherwise("close gripper;"),
    )


def point(p: Column) -> Column:
    """`[x, y]`, or `null`."""
    return F.when(p.isNull(), F.lit("null")).otherwise(F.concat(F.lit("["), F.array_join(F.transform(p, lambda x: x.cast("long").cast("string")), ", "), F.lit("]")))


def path(points: Column) -> Column:
    """Points joined by commas."""
    return F.array_join(F.transform(points, point), ", ")


def boxes(found: Column, names: Column, indent: str = "") -> Column:
    """`name: [x1, y1], [x2, y2]` lines of the boxes that are not null; unnamed ones are obj_i."""
    line = lambda b, i: F.when(b.isNotNull() & (F.size(b) == 4), F.concat(F.lit(indent), F.coalesce(F.get(names, i), F.concat(F.lit("obj_"), i.cast("string"))), F.lit(": "), point(F.slice(b, 1, 2)), F.lit(", "), point(F.slice(b, 3, 2))))
    return F.array_join(F.filter(F.transform(found, line), lambda x: x.isNotNull()), "\n")


def parse_boxes(text: Column) -> Column:
    """A map of name to four numbers from such lines; of lines with one name the last counts."""
    hits = F.filter(F.split(text, "\n"), lambda s: s.rlike(r"^\s*[^:]+: \[-?\d+, -?\d+\], \[-?\d+, -?\d+\]\s*$"))
    entry = F.transform(hits, lambda s: F.struct(F.trim(F.regexp_extract(s, "^([^:]+):", 1)).alias("key"), F.transform(F.regexp_extract_all(s, F.lit(r"(-?\d+)[,\]]"), 1), lambda x: x.cast("long")).alias("value")))
    last = F.filter(entry, lambda e, i: ~F.exists(F.slice(entry, i + 2, F.size(entry)), lambda later: later["key"] == e["key"]))
    return F.map_from_entries(last)


def first_point(text: Column) -> Column:
    """The first `[x, y]` of a text as two numbers, or null."""
    x, y = (F.regexp_extract(text, r"\[\s*(-?\d+)\s*,\s*(-?\d+)\s*\]", i) for i in (1, 2))
    return F.when(x != "", F.array(x.cast("long"), y.cast("long")))


def parse_plan(text: Column) -> Column:
    """Steps of `1. label: [x, y], [x, y], [x, y]` lines: number, label and points."""
    lines = F.filter(F.split(text, "\n"), lambda s: s.rlike(r"^\s*\d+\.\s"))
    return F.transform(lines, lambda s: F.struct(
        F.regexp_extract(s, r"^\s*(\d+)\.", 1).cast("long").alias("number"),
        F.trim(F.regexp_extract(s, r"^\s*\d+\.\s*([^:\[]+)", 1)).alias("label"),
        F.regexp_extract_all(s, F.lit(r"\[-?\d+, -?\d+\]"), 0).alias("points"),
    ))


def render_plan(labels: Column) -> Column:
    """Numbered lines."""
    return F.array_join(F.transform(labels, lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x)), "\n")


def parse_labels(text: Column) -> Column:
    """The last braced literal {number: [label, reason]} as a map; empty where there is none or it is no map."""
    braced = F.regexp_extract(text, r"(?s)(\{.*\})", 1)
    keyed = F.regexp_replace(braced, r"([{,]\s*)(\d+)\s*:", '$1"$2":')
    found = F.from_json(keyed, "map<string,array<string>>", {"allowSingleQuotes": "true"})
    return F.coalesce(F.transform_keys(found, lambda k, _: k.cast("long")), F.expr("cast(map() as map<bigint,array<string>>)"))


def parse_list(text: Column) -> Column:
    """The first bracketed list of a text, code fences aside: stripped, not empty items; null if none is left."""
    bare = F.regexp_replace(text, r"```[a-z]*", "")
    items = F.from_json(F.regexp_extract(bare, r"(?s)(\[.*?\])", 1), "array<string>", {"allowSingleQuotes": "true"})
    items = F.filter(F.transform(items, lambda x: F.trim(x)), lambda x: x != "")
    return F.when(F.size(items) > 0, items)


def check_labels(text: Column, segments: Column, allowed: Column) -> Column:
    """Why a labelling is invalid, or `ok`."""
    found = parse_labels(text)
    pairs = F.map_values(found)
    return (
        F.when(F.size(found) == 0, "unreadable")
        .when(F.exists(pairs, lambda p: F.size(p) != 2), "not pairs")
        .when(F.exists(pairs, lambda p: ~F.array_contains(allowed, F.element_at(p, 1))), "unknown label")
        .when(F.size(found) != segments, "wrong count")
        .otherwise("ok")
    )


def phase(label: Column, rules: list[tuple[str, str]] = PHASES, default: str = "other") -> Column:
    """The first rule whose words a label holds."""
    out = None
    for name, words in rules:
        hit = F.lower(label).rlike(rf"\b({words})\b")
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(default)


def destination(label: Column) -> Column:
    """What follows the last to, on, in, into or onto, without a final period; null if nothing does."""
    found = F.rtrim(F.regexp_extract(label, r"^.*\b(?:into|onto|to|on|in)\s+(.+)$", 1))
    found = F.regexp_replace(found, r"\.$", "")
    return F.when(found != "", found)


def spoken_name(name: Column) -> Column:
    """Underscores to blanks, a final number dropped."""
    return F.trim(F.translate(F.regexp_replace(name, r"_\d+$", ""), "_", " "))


def step_text(kind: Column, thing: Column, place: Column) -> Column:
    """Phase, object and destination in words."""
    return F.when((kind == "place") & place.isNotNull(), F.concat(F.lit("place the "), thing, F.lit(" to "), place)).otherwise(F.concat(kind, F.lit(" the "), thing))


def natural_number(name: Column, none: int = 1_000_000_000) -> Column:
    """The number at the end of a name, for natural order; names without one come last."""
    return F.coalesce(F.regexp_extract(name, r"(\d+)$", 1).try_cast("long"), F.lit(none).cast("long"))


def camel_words(name: Column) -> Column:
    """CamelCase to words."""
    return F.regexp_replace(name, r"(?<=[a-z0-9])(?=[A-Z])", " ")


def plain(text: Column) -> Column:
    """Lower case; runs of anything but letters and digits become one blank."""
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def singular(word: Column) -> Column:
    """Without the final s of words over three letters."""
    return F.when((F.length(word) > 3) & word.endswith("s"), F.regexp_replace(word, "s$", "")).otherwise(word)


def tokens(text: Column) -> Column:
    """Distinct words of ASCII letters in lower case, stop words aside."""
    return F.array_except(F.regexp_extract_all(F.lower(text), F.lit("[a-z]+"), 0), F.array(*map(F.lit, STOP_WORDS)))


def jaccard(a: Column, b: Column) -> Column:
    """Shared words among all words of two sets; 0 for two empty ones."""
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)).cast("double"), F.size(F.array_union(a, b)).cast("double")), F.lit(0.0))


def clean_prompt(text: Column) -> Column:
    """Outer blanks off, underscores and line feeds to blanks."""
    return F.translate(F.trim(text), "_\n", "  ")


def padded_tokens(ids: Column, size: int, fill: int = 0) -> tuple[Column, Column]:
    """Cut or filled to ``size``, with the mask of real ones."""
    real = F.least(F.size(ids), F.lit(size))
    return F.concat(F.slice(ids, 1, size), F.array_repeat(F.lit(fill).cast("long"), size - real)), F.concat(F.array_repeat(F.lit(True), real), F.array_repeat(F.lit(False), size - real))


def short_hash(text: Column) -> Column:
    """The first eight hex digits of the MD5 as a number."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def seed_hash(text: Column) -> Column:
    """The low 128 bits of the SHA-256, in hex."""
    return F.substring(F.sha2(text, 256), 33, 32)


def uniform(text: Column) -> Column:
    """A number in [0, 1) from the first 13 hex digits of the SHA-256: the same anywhere, in any order."""
    return F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("double") / float(16**13)


def moved_path(text: Column, prefix: str, to: str) -> Column:
    """Paths that begin with a prefix, given another."""
    return F.regexp_replace(text, f"(^|\")({prefix})/", f"$1{to}/")
