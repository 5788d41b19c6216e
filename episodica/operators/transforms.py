"""Transforms of frames: chained, grouped for inputs and outputs, and undone in reverse."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..functions.texts import uniform

Step = Callable[[DataFrame], DataFrame]


def chain(df: DataFrame, steps: Sequence[Step]) -> DataFrame:
    """All steps in order; an error names the step."""
    for i, step in enumerate(steps):
        try:
            df = df.transform(step)
        except Exception as e:
            raise ValueError(f"step {i} failed: {e}") from e
    return df


@dataclass(frozen=True)
class Group:
    """Steps before a model and after it: new inputs go last, new outputs first."""

    inputs: tuple[Step, ...] = ()
    outputs: tuple[Step, ...] = ()

    def push(self, inputs: Sequence[Step] = (), outputs: Sequence[Step] = ()) -> Group:
        return Group((*self.inputs, *inputs), (*outputs, *self.outputs))


@dataclass
class Modality:
    """A change of some vector columns by their statistics that can be undone; in training, with noise after it.

    ``stats``: column -> {mean, std} or {q01, q99}, each a list of numbers. Noise is uniform
    within ``noise`` to either side, by a hash of seed, ``key`` (a column) and place: the same
    in every run. It is not undone.
    """

    columns: Sequence[str]
    stats: Mapping[str, Mapping[str, Sequence[float]]]
    quantiles: bool = False
    training: bool = True
    noise: float = 0.0
    key: str | None = None
    seed: object = 0

    def _figures(self, column: str) -> tuple[Column, Column]:
        if column not in self.stats:
            raise KeyError(column)
        names = ("q01", "q99") if self.quantiles else ("mean", "std")
        return tuple(F.array(*(F.lit(float(x)) for x in self.stats[column][n])) for n in names)  # type: ignore[return-value]

    def _noisy(self, v: Column) -> Column:
        if not (self.training and self.noise):
            return v
        if self.key is None:
            raise ValueError("noise needs the key of a row")
        at = lambda i: uniform(F.concat_ws("|", F.lit(str(self.seed)), F.col(self.key).cast("string"), i.cast("string")))
        return F.transform(v, lambda x, i: x + self.noise * (at(i) * 2 - 1))

    def apply(self, df: DataFrame) -> DataFrame:
        f = V.to_quantiles if self.quantiles else V.zscore
        return df.withColumns({c: self._noisy(f(F.col(c), *self._figures(c))) for c in self.columns})

    def unapply(self, df: DataFrame) -> DataFrame:
        f = V.from_quantiles if self.quantiles else V.unzscore
        return df.withColumns({c: f(F.col(c), *self._figures(c)) for c in self.columns})


@dataclass
class Composed:
    """Modalities in order; undone in reverse."""

    parts: Sequence[Modality] = field(default_factory=tuple)

    def train(self, on: bool = True) -> Composed:
        for p in self.parts:
            p.training = on
        return self

    def apply(self, df: DataFrame) -> DataFrame:
        return chain(df, [p.apply for p in self.parts])

    def unapply(self, df: DataFrame) -> DataFrame:
        return chain(df, [p.unapply for p in reversed(self.parts)])


def default_prompt(text: str) -> Step:
    """``prompt`` where there is none."""
    return lambda df: df.withColumn("prompt", F.coalesce(F.col("prompt"), F.lit(text)) if "prompt" in df.columns else F.lit(text))


def prompt_of_task(tasks: DataFrame) -> Step:
    """``prompt`` from task_index; an index without a text is an error when the row is read."""
    known = tasks.select("task_index", F.col("task").alias("__t"))

    def step(df: DataFrame) -> DataFrame:
        found = df.join(known, "task_index", "left")
        return found.withColumn("prompt", F.coalesce("__t", F.raise_error(F.concat(F.lit("no task "), F.col("task_index").cast("string"))))).drop("__t")

    return step


def policy_input(state: str, actions: str, size: int) -> Step:
    """State and each action padded to a model's size."""
    return lambda df: df.withColumns({state: V.pad(F.col(state), size), actions: F.transform(F.col(actions), lambda a: V.pad(a, size))})


def image_slots(slots: Mapping[str, str | None], mask_missing: bool = True) -> Step:
    """``images`` and ``image_masks``: a struct each, with a field for every slot of a model.

    A slot without a column, or a row without that image, gets zeros of the size of the first
    slot's image, and a mask that is false (true where missing images are not to be masked).
    """

    def step(df: DataFrame) -> DataFrame:
        named = [c for c in slots.values() if c is not None]
        if not named:
            raise ValueError("no slot has a column")
        blank = F.transform(F.col(named[0]), lambda x: F.lit(0.0))
        images = F.struct(*((blank if c is None else F.coalesce(F.col(c), blank)).alias(k) for k, c in slots.items()))
        there = F.struct(*((F.lit(not mask_missing) if c is None else F.col(c).isNotNull() | F.lit(not mask_missing)).alias(k) for k, c in slots.items()))
        return df.withColumns({"images": images, "image_masks": there})

    return step


def policy_output(actions: str, size: int) -> Step:
    """Each action cut to the robot's size."""
    return lambda df: df.withColumn(actions, F.transform(F.col(actions), lambda a: F.slice(a, 1, size)))


def action_parts(v: Column) -> dict[str, Column]:
    """Position, rotation (as six numbers) and gripper of a vector of 7, and the base mode of one of 8."""
    return {"pos": V.part(v, 0, 3), "rot": V.part(v, 3, 6), "rot_6d": V.six_of(V.part(v, 3, 6)), "gripper": F.get(v, F.lit(6)), "base_mode": F.get(v, F.lit(7))}


def task_object(boxes: Column, names: Column, category: Column | None = None) -> dict[str, Column]:
    """The first box is the task's object, the rest distract from it; its name is the category, else the first name, else `object`."""
    first = F.get(names, F.lit(0))
    name = F.coalesce(first, F.lit("object")) if category is None else F.coalesce(category, first, F.lit("object"))
    rest = lambda x: F.slice(x, 2, F.greatest(F.size(x) - 1, F.lit(0)))
    return {"task_box": F.get(boxes, F.lit(0)), "task_name": name, "distractors": rest(boxes), "distractor_names": F.coalesce(rest(names), F.array().cast("array<string>"))}


def subset_of_words(words: Column, text: Column) -> Column:
    """Whether a text has all words of a name."""
    said = F.split(F.lower(text), "[^a-z0-9]+")
    return F.forall(words, lambda w: F.array_contains(said, w))


def scene_targets(scenes: DataFrame, things: DataFrame, key: str, ref: str, said: str, thing: str) -> DataFrame:
    """key, query and label, once each: what a scene refers to, and for a scene that refers to nothing every thing whose words its instruction has.

    A thing is looked for by one of its words, the rarest over all things, so a scene meets
    things that share a telling word with it and not all of them.
    """
    words = lambda c: F.array_distinct(F.filter(F.split(F.lower(c), "[^a-z0-9]+"), lambda w: w != ""))
    known = things.select(thing, words(F.col(thing)).alias("__words")).where(F.size("__words") > 0)
    spread = known.select(thing, F.explode("__words").alias("__word"))
    counts = spread.groupBy("__word").agg(F.count("*").alias("__n"))
    rarest = spread.join(counts, "__word").groupBy(thing).agg(F.min(F.struct("__n", "__word")).alias("__r")).select(thing, F.col("__r.__word").alias("__word"))
    open_ = scenes.where(F.col(ref).isNull()).select(key, said, F.explode(words(F.col(said))).alias("__word"))
    met = open_.join(rarest, "__word").join(known, thing).where(subset_of_words(F.col("__words"), F.col(said)))
    referred = scenes.where(F.col(ref).isNotNull()).select(key, F.col(ref).alias("query"), F.col(ref).alias("label"))
    return referred.unionByName(met.select(key, F.col(thing).alias("query"), F.lower(thing).alias("label"))).distinct()


def token_layout(prefix: Column, suffix: Column, size: int, fill: int = 0) -> dict[str, Column]:
    """Prefix and suffix ids in one row of ``size``, with masks: real, autoregressive (suffix), counted in the loss (suffix)."""
    from ..functions.texts import padded_tokens

    ids, real = padded_tokens(F.concat(prefix, suffix), size, fill)
    after = F.transform(real, lambda r, i: r & (i >= F.size(prefix)))
    return {"tokens": ids, "mask": real, "ar_mask": after.cast("array<int>"), "loss_mask": after}


def sample_rows(df: DataFrame, rows: Callable, schema: str, key: str = "ep") -> DataFrame:
    """A table function of an episode: its pandas frame to any number of rows."""
    return df.groupBy(key).applyInPandas(rows, schema)


def scene_path(number: Column, kind: str) -> Column:
    """Folder of a layout or a style: numbers 1 to 10 are for tests."""
    return F.format_string(f"{kind}s/%s/{kind}%03d.yaml", F.when(number.between(1, 10), "test").otherwise("train"), number.cast("long"))


def work_units(units: DataFrame, key: str, work: Callable, schema: str, tries: int = 3) -> DataFrame:
    """key, tries, error and the columns of ``schema``: what ``work`` makes of each unit (a row as a dict, to a list of rows), in its place.

    A unit that raises is tried again, ``tries`` times at most; one that never succeeds is one
    row with its last error and nulls, so the others' results stay. Results are told apart by
    the unit's key and ``place``, whatever task made them and when; a lost task's units are
    worked on anew. Units are rows of any number, spread as the table is.
    """
    names = [f.split()[0] for f in schema.split(",")]

    def tried(unit: dict) -> list[tuple]:
        error = None
        for n in range(1, tries + 1):
            try:
                return [(unit[key], i, n, None, *r) for i, r in enumerate(work(unit))]
            except Exception as e:  # noqa: BLE001  (a unit's error is its result)
                error = f"{type(e).__name__}: {e}"
        return [(unit[key], 0, tries, error, *[None] * len(names))]

    def run(frames):  # noqa: ANN001, ANN202
        for pdf in frames:
            for first in range(0, len(pdf), 1000):
                rows = [r for unit in pdf[first : first + 1000].to_dict("records") for r in tried(unit)]
                yield pd.DataFrame(rows, columns=[key, "place", "tries", "error", *names]).astype(object)

    return units.mapInPandas(run, f"{key} {dict(units.dtypes)[key]}, place long, tries long, error string, {schema}")
