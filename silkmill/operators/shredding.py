"""Deeply nested, semi-structured records as flat tables with parent-child links.

Columnar shredding: every leaf path of a record becomes three parallel arrays, the repetition
levels, the definition levels and the values. Nested columns are shredded a batch at a time from the
offsets and validity bits of their Arrow arrays; only JSON text inside them, and records found in raw
texts, are walked one by one. Tables are rebuilt from the level sequences alone, one table per
repeated ancestor; a row's key is the record's id with the position at each repeated ancestor, so the
key without its last position is the key of the parent. ``assembled`` gives the record back.

A path is written ``a[].b.c[]`` or ``a[].m{}.key``: ``[]`` marks a list and ``{}`` a map, whose entries
have a key and a value; a map's entry is also reached by its name, as ``m.name``. Levels follow the
usual rule, with three definition levels for a repeated field (there, slot present, slot not null),
so null entries keep their position, and a null, an empty list and a list of nulls differ.

Defined results: a missing or null field, an empty list, or a value of the wrong kind ends the path
there (no rows below it); a single value where a list is expected counts as a list of one; JSON text
where a list or an object is expected counts as that list or object; text that is not JSON stays text.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LEVELS = T.StructType([T.StructField("rep", T.ArrayType(T.IntegerType())), T.StructField("def", T.ArrayType(T.IntegerType())), T.StructField("value", T.ArrayType(T.StringType()))])


@dataclass(frozen=True)
class LeafPath:
    """A parsed leaf path. ``own``: the field taken from an object that stands at the leaf (None: its JSON text)."""

    text: str
    own: str | None = None

    @property
    def steps(self) -> list[tuple[str, str]]:
        """Names with "[]" for a list, "{}" for a map, else "", from the root."""
        return [(s[:-2], s[-2:]) if s[-2:] in ("[]", "{}") else (s, "") for s in self.text.split(".")]

    @property
    def depth(self) -> int:
        """Number of repeated fields on the path."""
        return sum(bool(kind) for _, kind in self.steps)

    def slot_levels(self) -> list[int]:
        """The definition level from which the slot at each repeated field exists; at the next it isn't null."""
        level, out = 0, []
        for _, kind in self.steps:
            level += 3 if kind else 1
            if kind:
                out.append(level - 1)
        return out

    @property
    def full(self) -> int:
        return sum(3 if kind else 1 for _, kind in self.steps)

    @property
    def column(self) -> str:
        """The name of the path's column of levels; a dot would mean a field."""
        return self.text.replace(".", "/")

    @property
    def ancestors(self) -> str:
        """The path down to its last repeated field: paths with the same are columns of one table."""
        return self.text[: max(self.text.rfind("[]"), self.text.rfind("{}")) + 2] if self.depth else ""


def levels_schema(paths: list[LeafPath]) -> T.StructType:
    """One row a record: its id and a struct of level arrays for each path."""
    return T.StructType([T.StructField("record_id", T.LongType()), *(T.StructField(p.column, _LEVELS) for p in paths)])


def _parsed(value: object, kinds: tuple[type, ...]) -> object:
    """JSON text in place of one of ``kinds`` as that value; anything else unchanged."""
    if isinstance(value, str) and value.lstrip()[:1] in ("{", "[") and value.strip():
        try:
            inner = json.loads(value)
        except (ValueError, RecursionError):
            return value
        if isinstance(inner, kinds):
            return inner
    return value


def _leaf_text(value: object, own: str | None) -> str | None:
    if own is not None:
        value = _parsed(value, (dict,))
        if isinstance(value, dict):
            value = value.get(own)
    if value is None or isinstance(value, str):
        return value
    return json.dumps(value, ensure_ascii=False)


def _walk(node: object, steps: list[tuple[str, str]], own: str | None, rep: int, level: int, depth: int, out: Callable[[int, int, str | None], None]) -> None:
    """Level entries of what the rest of a path reaches from one value."""
    if not steps:
        text = _leaf_text(node, own)
        out(rep, level if text is not None else level - 1, text)
        return
    (name, kind), rest = steps[0], steps[1:]
    node = _parsed(node, (dict,))
    child = node.get(name) if isinstance(node, dict) else None
    if child is None:
        out(rep, level, None)
    elif not kind:
        _walk(child, rest, own, rep, level + 1, depth, out)
    else:
        _walk_items(child, kind, rest, own, rep, level, depth, out)


def _walk_items(child: object, kind: str, rest: list[tuple[str, str]], own: str | None, rep: int, level: int, depth: int, out: Callable[[int, int, str | None], None]) -> None:
    if kind == "{}":
        child = _parsed(child, (dict,))
        if not isinstance(child, dict):
            out(rep, level, None)
            return
        items: list = [{"key": k, "value": v} for k, v in child.items()]
    else:
        child = _parsed(child, (list, dict))
        items = child if isinstance(child, list) else [child]
    if not items:
        out(rep, level + 1, None)
    for k, item in enumerate(items):
        at = rep if k == 0 else depth + 1
        if item is None:
            out(at, level + 2, None)
        else:
            _walk(item, rest, own, at, level + 3, depth + 1, out)


def shred_record(record: object, path: LeafPath) -> tuple[list[int], list[int], list[str | None]]:
    """Repetition levels, definition levels and values of one leaf path of one record (never empty)."""
    entries: list[tuple[int, int, str | None]] = []
    _walk(record, path.steps, path.own, 0, 0, 0, lambda *e: entries.append(e))
    return tuple(map(list, zip(*entries, strict=True)))


def _entry(maps: pa.MapArray, at: np.ndarray, alive: np.ndarray, name: str) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The values of maps, where the one of key ``name`` is for each map ``at``, and whether there is one."""
    offsets, at = np.append(maps.offsets.to_numpy(), 0), np.where(alive, at, 0)
    places = np.flatnonzero(pc.equal(maps.keys, name).to_numpy(zero_copy_only=False))
    start, end = offsets[at], offsets[at + 1]
    first = np.searchsorted(places, start)
    place = places[np.minimum(first, len(places) - 1)] if len(places) else np.zeros(len(at), np.int64)
    return maps.items, place, alive & (first < len(places)) & (place < end)


def _valid(array: pa.Array, at: np.ndarray, alive: np.ndarray) -> np.ndarray:
    """Of those alive, the places whose value is not null."""
    if not array.null_count:
        return alive
    out = alive.copy()
    out[alive] = array.is_valid().to_numpy(zero_copy_only=False)[at[alive]]
    return out


def shred_arrow(columns: dict[str, pa.Array], n: int, path: LeafPath) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Record number, repetition level, definition level and value of each entry of one leaf path of ``n`` records.

    Each step goes from the entries so far to those a level deeper: a list's offsets say how often each is repeated.
    """
    record, at, alive = np.arange(n), np.arange(n), np.ones(n, bool)
    rep, level = np.zeros(n, np.int32), np.zeros(n, np.int32)
    here: pa.Array | None = None
    depth, steps = 0, path.steps
    for i, (name, kind) in enumerate(steps):
        if here is None:
            here = columns[name]
            found = alive
        elif pa.types.is_struct(here.type) and here.type.get_field_index(name) >= 0:
            here, found = here.field(here.type.get_field_index(name)), alive
        elif isinstance(here, pa.MapArray):
            here, at, found = _entry(here, at, alive, name)
        else:  # nothing has fields here but JSON text
            return _shred_values(here, at, alive, record, rep, level, depth, steps[i:], path.own, False)
        found = _valid(here, at, found)
        if not kind:
            level = level + found
            alive = found
            continue
        repeated = isinstance(here, (pa.MapArray, pa.ListArray, pa.LargeListArray)) and (kind == "{}") == isinstance(here, pa.MapArray)
        if not repeated and (kind == "{}" or not pa.types.is_struct(here.type)):
            return _shred_values(here, at, found, record, rep, level, depth, steps[i:], path.own, True)
        if repeated:
            offsets, safe = np.append(here.offsets.to_numpy(), 0), np.where(found, at, 0)
            start = np.where(found, offsets[safe], 0)
            count = np.where(found, offsets[safe + 1] - start, 0)
            here = pa.StructArray.from_arrays([here.keys, here.items], ["key", "value"]) if kind == "{}" else here.values
        else:  # a single object counts as a list of one
            start, count = at, found.astype(np.int64)
        many = np.maximum(count, 1)
        of = np.repeat(np.arange(len(at)), many)
        within = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
        slot = (count > 0)[of]
        rep = np.where(within == 0, rep[of], depth + 1).astype(np.int32)
        level, record, at = level[of] + found[of] + slot, record[of], np.where(slot, start[of] + within, 0)
        alive = _valid(here, at, slot)
        level = level + alive
        depth += 1
    return record, rep, level.astype(np.int32), _leaf_values(here, at, alive, level, path.own)


def _leaf_values(here: pa.Array, at: np.ndarray, alive: np.ndarray, level: np.ndarray, own: str | None) -> pa.Array:
    """The leaf's values as text, null where the path has ended; an object's missing field ends it too (``level`` changes)."""
    if not len(here):
        return pa.nulls(len(at), pa.string())
    taken = here.take(pa.array(np.where(alive, at, 0), mask=~alive))
    if pa.types.is_string(taken.type) and own is None:
        return taken
    if pa.types.is_string(taken.type):
        odd = np.flatnonzero(pc.fill_null(pc.match_substring_regex(taken, r"^\s*\{"), False).to_numpy(zero_copy_only=False))
        if not len(odd):
            return taken
        texts = taken.to_pylist()
        for k in odd:
            texts[k] = _leaf_text(texts[k], own)
            level[k] -= texts[k] is None
        return pa.array(texts, pa.string())
    texts = [_leaf_text(v, own) for v in taken.to_pylist()]
    gone = np.array([t is None for t in texts], bool) & alive
    level[gone] -= 1
    return pa.array(texts, pa.string())


def _shred_values(here: pa.Array, at: np.ndarray, alive: np.ndarray, record: np.ndarray, rep: np.ndarray, level: np.ndarray, depth: int, steps: list[tuple[str, str]], own: str | None, found: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """The rest of a path below values without nested type: JSON text is walked, plain text is a list of one.

    ``found``: the values are those of the first of ``steps``, else those that should have its field.
    """
    values = here.take(pa.array(np.where(alive, at, 0), mask=~alive)).to_pylist() if len(here) else [None] * len(at)
    many, out = np.ones(len(at), np.int64), []
    for k, value in enumerate(values):
        before = len(out)
        entry = lambda *e: out.append(e)
        if value is None:
            entry(rep[k], level[k], None)
        elif found and len(steps) == 1 and steps[0][1] == "[]" and isinstance(value, str) and value.lstrip()[:1] not in ("{", "["):
            entry(rep[k], level[k] + 3, value)
        elif found:
            _walk_items(value, steps[0][1], steps[1:], own, rep[k], level[k], depth, entry)
        else:
            _walk(value, steps, own, rep[k], level[k], depth, entry)
        many[k] = len(out) - before
    reps, levels, texts = zip(*out, strict=True) if out else ((), (), ())
    return np.repeat(record, many), np.array(reps, np.int32), np.array(levels, np.int32), pa.array(texts, pa.string())


def outermost_json(raw: str | None) -> object:
    """The outermost JSON list or object inside ``raw``, or None where there is none or it is incomplete.

    Fences and prose around it are skipped, also brackets in that prose; once a bracket opens JSON,
    nothing inside it is taken in its place, so a text that was cut off gives nothing.
    """
    if not raw:
        return None
    decoder, at = json.JSONDecoder(strict=False), 0
    while True:
        starts = [x for x in (raw.find("{", at), raw.find("[", at)) if x >= 0]
        if not starts:
            return None
        start = min(starts)
        inside = raw[start + 1 :].lstrip()
        opens_json = inside[:1] in ('"', "}", "") if raw[start] == "{" else inside[:1] in tuple('"{[]-0123456789') + ("",) or inside[:4] in ("null", "true") or inside[:5] == "false"
        try:
            value, _ = decoder.raw_decode(raw, start)
        except RecursionError:
            return None
        except ValueError as error:
            if opens_json and not (raw[start] == "[" and inside[:1] in "-0123456789" and error.pos - start < 12):
                return None
            at = start + 1
            continue
        if isinstance(value, dict) or any(isinstance(x, (dict, list)) for x in value):
            return value
        at = start + 1


def records_in(value: object, id_field: str) -> Iterator[dict]:
    """Every object that has ``id_field``, however it is wrapped; records are not searched for further records."""
    stack = [value]
    while stack:
        node = _parsed(stack.pop(), (dict, list))
        if isinstance(node, dict):
            if isinstance(node.get(id_field), (int, str)):
                yield node
            else:
                stack.extend(reversed(list(node.values())))
        elif isinstance(node, list):
            stack.extend(reversed(node))


def _level_struct(offsets: np.ndarray, rep: np.ndarray, level: np.ndarray, values: pa.Array) -> pa.StructArray:
    at = pa.array(offsets, pa.int32())
    return pa.StructArray.from_arrays([pa.ListArray.from_arrays(at, x) for x in (pa.array(rep, pa.int32()), pa.array(level, pa.int32()), values)], ["rep", "def", "value"])


def _shredder(names: list[str], paths: list[LeafPath]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Batches of (record_id, nested columns) to level rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {name: batch.column(k + 1) for k, name in enumerate(names)}
            out = [batch.column(0)]
            for path in paths:
                record, rep, level, values = shred_arrow(columns, batch.num_rows, path)
                out.append(_level_struct(np.searchsorted(record, np.arange(batch.num_rows + 1)), rep, level, values))
            yield pa.RecordBatch.from_arrays(out, names=["record_id", *(p.column for p in paths)])

    return run


def _raw_shredder(paths: list[LeafPath], id_field: str) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Batches of raw texts, each with any number of records, to level rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids: list[int] = []
            found: list[dict] = []
            for body in batch.column(0).to_pylist():
                for record in records_in(outermost_json(body), id_field):
                    try:
                        own_id = int(record[id_field])
                    except ValueError:
                        continue
                    if -(2**63) <= own_id < 2**63:
                        ids.append(own_id)
                        found.append(record)
            out = [pa.array(ids, pa.int64())]
            for path in paths:
                levels = [shred_record(r, path) for r in found]
                offsets = np.cumsum([0, *(len(x[0]) for x in levels)])
                rep, level, values = ([e for x in levels for e in x[k]] for k in range(3))
                out.append(_level_struct(offsets, np.array(rep, np.int32), np.array(level, np.int32), pa.array(values, pa.string())))
            yield pa.RecordBatch.from_arrays(out, names=["record_id", *(p.column for p in paths)])

    return run


def shred(df: DataFrame, id_col: str, columns: dict[str, object] | list[str], paths: list[LeafPath]) -> DataFrame:
    """Level rows (``levels_schema``) of a table with nested columns, one row per record.

    ``columns`` names the nested columns, or gives a Column for each name so that unused parts are
    pruned before they leave the JVM. Other columns of ``df`` are not touched, whatever their names.
    """
    named = {c: F.col(f"`{c}`") for c in columns} if isinstance(columns, list) else columns
    return df.select(F.col(f"`{id_col}`").cast("long").alias("record_id"), *[c.alias(n) for n, c in named.items()]).mapInArrow(_shredder(list(named), paths), levels_schema(paths))


def shred_raw(df: DataFrame, raw_col: str, id_field: str, paths: list[LeafPath]) -> DataFrame:
    """Level rows of the records found in a column of raw texts (fenced, wrapped, refused or cut-off model output)."""
    return df.select(F.col(f"`{raw_col}`").alias("body")).where(F.col("body").isNotNull()).mapInArrow(_raw_shredder(paths, id_field), levels_schema(paths))


def slot_positions(rep: np.ndarray, level: np.ndarray, slots: list[int]) -> np.ndarray:
    """Positions at each repeated field (columns) of each level entry (rows), from the levels alone; -1: no such slot.

    ``rep`` may run over many records one after another: a repetition level of 0 starts a record.
    """
    n = len(rep)
    out = np.full((n, len(slots)), -1, np.int32)
    for k, slot in enumerate(slots, start=1):
        starts = rep < k  # a new list at this depth
        new = (rep <= k) & (level >= slot)
        count = np.cumsum(new)
        before = np.maximum.accumulate(np.where(starts, count - new, 0)) if n else count
        out[:, k - 1] = np.where(level >= slot, count - before - 1, -1)
    return out


def _entries(column: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Number of entries of each record, and all records' repetition levels, definition levels and values."""
    rep, level, value = (column.field(k) for k in range(3))
    return np.diff(rep.offsets.to_numpy()), rep.flatten().to_numpy(zero_copy_only=False), level.flatten().to_numpy(zero_copy_only=False), value.flatten()


def _rebuilder(paths: list[LeafPath]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, path in enumerate(paths):
                lengths, rep, level, values = _entries(batch.column(k + 1))
                positions = slot_positions(rep, level, path.slot_levels())
                take = level >= path.full
                ids = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), lengths)[take]
                names = ["record_id", "path", *(f"pos_{k}" for k in range(path.depth)), "value"]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([path.text] * len(ids), pa.string()), *(pa.array(positions[take, k]) for k in range(path.depth)), values.filter(pa.array(take))], names=names)

    return run


def _positions(depth: int) -> list[T.StructField]:
    return [T.StructField(f"pos_{k}", T.IntegerType()) for k in range(depth)]


def rebuild(levels: DataFrame, paths: list[LeafPath]) -> DataFrame:
    """The values of leaf paths with equally many repeated ancestors, in one pass over the levels.

    Columns: record_id, path, pos_0 .. pos_(k-1), the position at each repeated ancestor, and value.
    """
    (depth,) = {p.depth for p in paths}
    schema = T.StructType([T.StructField("record_id", T.LongType()), T.StructField("path", T.StringType()), *_positions(depth), T.StructField("value", T.StringType())])
    return levels.select("record_id", *[f"`{p.column}`" for p in paths]).mapInArrow(_rebuilder(paths), schema)


def rebuild_table(levels: DataFrame, columns: dict[str, LeafPath]) -> DataFrame:
    """The table of one repeated ancestor: record_id, pos_0 .. pos_(k-1) and a column for each leaf path below it.

    A row per slot that is not null, from the level sequences alone: paths below the same repeated
    ancestor have an entry for each of its slots, in the same order.
    """
    paths = list(columns.values())
    (_,) = {p.ancestors for p in paths}
    depth = paths[0].depth
    slot = paths[0].slot_levels()[-1] + 1 if depth else 0

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, rep, level, _ = _entries(batch.column(1))
            take = level >= slot
            positions = slot_positions(rep, level, paths[0].slot_levels())
            ids = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), lengths)[take]
            values = [_entries(batch.column(k + 1))[3].filter(pa.array(take)) for k in range(len(paths))]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *(pa.array(positions[take, k]) for k in range(depth)), *values], names=["record_id", *(f"pos_{k}" for k in range(depth)), *columns])

    schema = T.StructType([T.StructField("record_id", T.LongType()), *_positions(depth), *(T.StructField(c, T.StringType()) for c in columns)])
    return levels.select("record_id", *[f"`{p.column}`" for p in paths]).mapInArrow(run, schema)


def assembled(levels: dict[LeafPath, tuple[list[int], list[int], list[str | None]]]) -> dict:
    """A record with the parts that its level sequences tell of; what no path leads to is missing."""
    root: dict = {}
    for path, (rep, level, values) in levels.items():
        positions = slot_positions(np.array(rep, np.int32), np.array(level, np.int32), path.slot_levels())
        for row, defined, value in zip(positions, level, values, strict=True):
            node, reached, depth = root, 0, 0
            for i, (name, kind) in enumerate(path.steps):
                last = i == len(path.steps) - 1
                if defined <= reached:
                    node.setdefault(name, None)
                    break
                if not kind:
                    reached += 1
                    if last:
                        node[name] = value
                    elif node.get(name) is None:
                        node[name] = {}
                    node = node[name]
                    continue
                if node.get(name) is None:
                    node[name] = []
                items = node[name]
                if defined == reached + 1:
                    break  # an empty list
                place = int(row[depth])
                items += [None] * (place + 1 - len(items))
                if defined == reached + 2:
                    break  # a null entry
                if last:
                    items[place] = value
                elif items[place] is None:
                    items[place] = {}
                node, reached, depth = items[place], reached + 3, depth + 1
    return root
