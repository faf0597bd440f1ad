"""Model-bound operators behind replaceable adapters, with deterministic stubs.

A model is applied to Arrow batches; filters belong before it, since nothing is pushed through Python. One loaded by a
class or function of a module is loaded once per Python worker, on first use; one of a local function or a lambda, whose name
does not tell it from others, once a task.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions import grammar
from sparkloom.functions.pieces import in_pieces
from sparkloom.ship import ship

_LOADED: dict[str, Any] = {}


def loaded(name: str, load: Callable[[], Any]) -> Any:
    """The worker's instance of a model."""
    if name not in _LOADED:
        _LOADED[name] = load()
    return _LOADED[name]


def name_of(load: Callable[[], Any]) -> str | None:
    """A name that tells a loader from all others; None for local functions, lambdas and objects."""
    name = getattr(load, "__qualname__", "<")
    return None if "<" in name else f"{load.__module__}.{name}"


def with_model(rows: DataFrame, load: Callable[[], Any], apply: Callable[[Any, pd.DataFrame], pd.DataFrame], schema) -> DataFrame:
    """Rows through a model: ``apply(model, batch)`` gives a batch of ``schema``."""
    ship(rows.sparkSession)
    name = name_of(load)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = None
        for part in parts:
            if model is None:
                model = loaded(name, load) if name else load()
            yield apply(model, part)

    return rows.mapInPandas(run, schema)


class HashModel:
    """A stand-in for any text model: everything it answers is a digest of its input."""

    def __init__(self, dimensions: int = 8, labels: int = 3):
        self.dimensions, self.labels = dimensions, labels

    def _numbers(self, text: str, n: int) -> list[float]:
        return [hashlib.sha256(f"{i}:{text}".encode()).digest()[0] / 255 - 0.5 for i in range(n)]

    def generate(self, text: str) -> str:
        return "answer " + hashlib.sha256(text.encode()).hexdigest()[:8]

    def embed(self, text: str) -> list[float]:
        return self._numbers(text, self.dimensions)

    def classify(self, text: str) -> list[float]:
        return self._numbers("c" + text, self.labels)

    def reward(self, text: str) -> float:
        return self._numbers("r" + text, 1)[0]


#: Tasks of a text model: result type.
TASKS = {"generate": "string", "chat": "string", "embed": "array<double>", "encode": "array<double>", "classify": "array<double>", "reward": "double"}


def infer(rows: DataFrame, task: str, text: str = "text", output: str = "output", load: Callable[[], Any] = HashModel) -> DataFrame:
    """Adds the answer of a text model for a task."""
    if task not in TASKS:
        raise ValueError(f"unknown task {task}")
    method = {"chat": "generate", "encode": "embed"}.get(task, task)

    def apply(model, part: pd.DataFrame) -> pd.DataFrame:
        answer = getattr(model, method)
        return part.assign(**{output: [answer(t or "") for t in part[text]]})

    return with_model(rows, load, apply, f"{_ddl(rows)}, {output} {TASKS[task]}")


def _ddl(rows: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)


def score(rows: DataFrame, left: str, right: str, output: str = "score", load: Callable[[], Any] = HashModel) -> DataFrame:
    """Adds the cosine of the embeddings of two text columns."""
    from sparkloom.functions.vectors import cosine

    both = infer(infer(rows, "embed", left, "_a", load), "embed", right, "_b", load)
    return both.withColumn(output, cosine(F.col("_a"), F.col("_b"))).drop("_a", "_b")


# ---------------------------------------------------------------- stubs of the media models


def rasterised(documents: DataFrame, pages: str = "n_pages", dpi: int = 300) -> DataFrame:
    """A row for each page with the name of its image; pixels come from an adapter."""
    out = documents.withColumn("page", F.explode(F.sequence(F.lit(1), F.col(pages))))
    return out.withColumn("image_name", F.concat(F.lpad(F.col("page").cast("string"), 3, "0"), F.lit(".png"))).withColumn("dpi", F.lit(dpi))


def recognised(images: DataFrame, read: Callable[[str], str] | None = None) -> DataFrame:
    """Adds ``raw``: a page reader's JSON answer; the stub answers with the image's name."""

    @F.pandas_udf("string")
    def answer(names: pd.Series) -> pd.Series:
        import json

        return names.map(lambda n: read(n) if read else json.dumps({"primary_language": "en", "natural_text": f"text of {n}"}))

    return images.withColumn("raw", answer("image_name"))


def transcribed(segments: DataFrame, listen: Callable[[str, float, float], str] | None = None) -> DataFrame:
    """Adds ``text`` of a speech model; the stub names the span."""

    def apply(model, part: pd.DataFrame) -> pd.DataFrame:
        return part.assign(text=[model(a, s, e) for a, s, e in zip(part["audio"], part["start"], part["end"], strict=True)])

    stub = listen or (lambda a, s, e: f"{a} {s:g}-{e:g}")
    return with_model(segments, lambda: stub, apply, f"{_ddl(segments)}, text string")


def unwarped(images: DataFrame, transform: Callable[[bytes], bytes] | None = None) -> DataFrame:
    """content through an image adapter; the stub returns it unchanged."""

    def apply(model, part: pd.DataFrame) -> pd.DataFrame:
        return part.assign(content=[model(c) for c in part["content"]])

    same = transform or (lambda c: c)
    return with_model(images, lambda: same, apply, images.schema)


def detected(images: DataFrame, find: Callable[[str], list[tuple[str, float, list[float]]]] | None = None) -> DataFrame:
    """Rows pos, label, score, coordinate for every box of a layout model; the stub finds one text box a page."""

    def apply(model, part: pd.DataFrame) -> pd.DataFrame:
        found = part.assign(_b=[[(i, *box) for i, box in enumerate(model(name))] for name in part["image_name"]]).explode("_b").dropna(subset=["_b"])
        boxes = list(found.pop("_b"))
        return found.assign(**{n: pd.Series([b[i] for b in boxes], found.index, dtype=object) for i, n in enumerate(("pos", "label", "score", "coordinate"))})

    stub = find or (lambda name: [("text", 1.0, [0.0, 0.0, 100.0, 100.0])])
    return with_model(images, lambda: stub, apply, f"{_ddl(images)}, pos int, label string, score double, coordinate array<double>")


def diarised(audio: DataFrame, speakers: Callable[[str, float], list[tuple[float, float, str]]] | None = None, turn: float = 10.0) -> DataFrame:
    """Rows start, end, speaker for every turn of rows audio, seconds; the stub lets two speakers alternate every ``turn`` seconds."""

    def alternate(name: str, seconds: float) -> list[tuple[float, float, str]]:
        return [(k * turn, min((k + 1) * turn, seconds), f"SPEAKER_{k % 2:02}") for k in range(math.ceil(seconds / turn))]

    def apply(model, part: pd.DataFrame) -> pd.DataFrame:
        rows = [(a, *t) for a, s in zip(part["audio"], part["seconds"], strict=True) for t in model(a, s)]
        return pd.DataFrame(rows, columns=["audio", "start", "end", "speaker"])

    stub = speakers or alternate
    return with_model(audio.select("audio", "seconds"), lambda: stub, apply, "audio string, start double, end double, speaker string")


def enlarged_grid(grid: np.ndarray, height: int, width: int) -> np.ndarray:
    """A grid of points (rows, columns, 2), linear between its points, whose corners stay."""

    def along(values: np.ndarray, n: int) -> np.ndarray:
        place = np.linspace(0, len(values) - 1, n) if n > 1 else np.zeros(1)
        low = np.minimum(place.astype(int), max(0, len(values) - 2))
        high = np.minimum(low + 1, len(values) - 1)
        part = (place - low).reshape(-1, *[1] * (values.ndim - 1))
        return values[low] * (1 - part) + values[high] * part

    return along(along(grid, height).swapaxes(0, 1), width).swapaxes(0, 1)


def sampled_at(image: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Bilinear values of an image (rows, columns, ...) at points (x, y) in [-1, 1], corner to corner; 0 outside."""
    height, width = image.shape[:2]
    x, y = (points[..., 0] + 1) / 2 * (width - 1), (points[..., 1] + 1) / 2 * (height - 1)
    x0, y0 = np.floor(x).astype(int), np.floor(y).astype(int)
    out = np.zeros(points.shape[:-1] + image.shape[2:])
    for dy in (0, 1):
        for dx in (0, 1):
            xi, yi = x0 + dx, y0 + dy
            weight = (1 - np.abs(x - xi)) * (1 - np.abs(y - yi)) * ((xi >= 0) & (xi < width) & (yi >= 0) & (yi < height))
            own = image[np.clip(yi, 0, height - 1), np.clip(xi, 0, width - 1)]
            out += own * weight.reshape(weight.shape + (1,) * (own.ndim - weight.ndim))
    return out


def grid_unwarped(images: DataFrame, width: int, height: int) -> DataFrame:
    """image (rows of values) sampled where a coarse grid of points (x, y) says, at width x height. A null image stays null."""
    ship(images.sparkSession)

    def one(image, grid) -> list[list[float]] | None:
        if image is None or grid is None:
            return None
        points = np.array([[list(p) for p in row] for row in grid], float)
        return sampled_at(np.array([list(r) for r in image], float), enlarged_grid(points, height, width)).tolist()

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield part.drop(columns="grid").assign(image=[one(i, g) for i, g in zip(part["image"], part["grid"], strict=True)])

    return images.mapInPandas(run, images.drop("grid").schema)


def quietest_split(samples: list[float], rate: int, longest: float, window: int) -> list[tuple[int, int]]:
    """Spans of at most ``longest`` seconds, cut where a window in the last second before the limit has the least energy."""
    out, first, most = [], 0, int(longest * rate)
    while len(samples) - first > most:
        low, high = first + most - rate, first + most
        starts = range(low, max(low + 1, high - window), window)
        cut = min(starts, key=lambda s: (sum(x * x for x in samples[s : s + window]), s))
        out.append((first, cut))
        first = cut
    return [*out, (first, len(samples))]


def split_audio(audio: DataFrame, rate: int, longest: float, window: int) -> DataFrame:
    """audio, first, last sample of every span of rows audio, samples (array)."""

    ship(audio.sparkSession)

    def cut(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = [(a, f, t) for a, s in zip(part["audio"], part["samples"], strict=True) for f, t in quietest_split(list(s), rate, longest, window)]
            yield pd.DataFrame(rows, columns=["audio", "first", "last"])

    return audio.select("audio", "samples").mapInPandas(cut, "audio string, first long, last long")


# ---------------------------------------------------------------- custom logits processors, structured outputs


def _numbers(values: pa.Array) -> np.ndarray:
    out = values.to_numpy(zero_copy_only=False)
    return out.astype(np.int64) if out.dtype.kind in "iu" else out


class LogitsProcessor:
    """A function of one request's logits: ``function(token_ids, logits)`` or, with ``stateful``, ``function(token_ids, logits,
    outputs)`` gives the new logits (arrays, in order of token). ``rank_preserving`` says that it cannot change the greedy choice.

    The state of a stateful processor is the output tokens so far; ``update_state`` adds new ones before a step.
    """

    def __init__(self, function: Callable[..., np.ndarray], rank_preserving: bool = False, stateful: bool = False):
        self.function, self.rank_preserving, self.stateful = function, rank_preserving, stateful
        self.outputs: DataFrame | None = None

    def update_state(self, added: DataFrame | None, gone: DataFrame | None = None) -> None:
        """New output tokens (req, pos, token) of a step, and requests (req) that have left the batch."""
        if added is not None:
            added = added.select("req", "pos", "token")
            self.outputs = added if self.outputs is None else self.outputs.unionByName(added)
        if gone is not None and self.outputs is not None:
            self.outputs = self.outputs.join(gone.select("req"), "req", "left_anti")

    def __call__(self, rows: DataFrame) -> DataFrame:
        """Many requests a batch, one row each, so that Python is entered once for a batch of requests."""
        ship(rows.sparkSession)
        function, stateful = self.function, self.stateful
        own = [c for c in rows.columns if c != "req"]
        whole = rows.groupBy("req").agg(F.sort_array(F.collect_list(F.struct("token_id", *[c for c in own if c != "token_id"]))).alias("v"))
        if stateful and self.outputs is not None:
            ordered = self.outputs.groupBy("req").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "token"))), lambda t: t["token"].cast("long")).alias("outputs"))
            whole = whole.join(ordered, "req", "left")
        else:
            whole = whole.withColumn("outputs", F.lit(None).cast("array<long>"))

        def run(tokens: pa.Array, logits: pa.Array, given: pa.Array) -> pa.Array:
            # numbers stay in Arrow's buffers, of which a request's are a view
            ids, x, ends = _numbers(tokens.values), _numbers(logits.values).astype(float), tokens.offsets.to_numpy()
            starts, new, sizes = logits.offsets.to_numpy(), [], [0]
            for i in range(len(tokens)):
                more = (given[i].as_py() or [],) if stateful else ()
                own = x[starts[i] : starts[i + 1]].copy()
                new.append(np.asarray(function(ids[ends[i] : ends[i + 1]].copy(), own, *more), float))
                sizes.append(len(new[-1]))
            return pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), pa.array(np.concatenate([*new, np.zeros(0)])))

        given = [F.transform("v", lambda t: t["token_id"]), F.transform("v", lambda t: t["logit"].cast("double")), F.col("outputs")]
        done = whole.withColumn("logits", F.arrow_udf(in_pieces(run), "array<double>")(*given))
        each = done.select("req", F.explode(F.arrays_zip("v", "logits")).alias("z"))
        columns = {c: F.col("z.logits") if c == "logit" else F.col("req") if c == "req" else F.col(f"z.v.{c}") for c in rows.columns}
        return each.select(*[c.cast(rows.schema[n].dataType).alias(n) for n, c in columns.items()])


def processed(rows: DataFrame, processors: list[LogitsProcessor], greedy: bool = False, added: DataFrame | None = None) -> DataFrame:
    """All processors in order, each told of new output tokens first; rank-preserving ones are left out for greedy choices."""
    for p in processors:
        p.update_state(added)
        if not (greedy and p.rank_preserving):
            rows = p(rows)
    return rows


def meets(output: Column, kind: str, rule) -> Column:
    """Whether an output meets a constraint: json (schema text), regex, choice (list) or grammar (rules, see ``functions.grammar``)."""
    if kind == "json":
        return F.coalesce(F.try_parse_json(output).isNotNull() & F.from_json(output, rule).isNotNull(), F.lit(False))
    if kind == "regex":
        return output.rlike(f"^(?:{rule})$")
    if kind == "choice":
        return output.isin(*rule)
    if kind == "grammar":
        return F.coalesce(grammar.recognised(output, rule)["accepted"], F.lit(False))
    raise ValueError(f"unknown constraint {kind}")
