"""The boundary to text models: one client interface, bounded retries, a deterministic stand-in without network.

A model column is nondeterministic and dear: write it (``cut``) before it is used twice.
"""

from __future__ import annotations

import hashlib
import json
import os
import urllib.request
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from queue import Queue
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silkmill.functions.text import render
from silkmill.operators.dialog import chat_role


class ModelClient(Protocol):
    """``generate`` answers prompts in their order, None where it can't. ``chat``, where a model has it, answers
    conversations, each a list of {"role", "text"} from system, human and ai."""

    def generate(self, prompts: list[str]) -> list[str | None]: ...


class StubModel:
    """Answers by rule, the same everywhere: "True" or "False" to prompts that ask for one, else a line about the prompt."""

    def generate(self, prompts: list[str]) -> list[str | None]:
        out: list[str | None] = []
        for p in prompts:
            h = hashlib.md5(p.encode()).hexdigest()
            if "True" in p and "False" in p:
                out.append("True" if int(h, 16) % 4 else "False")
            elif "JSON" in p:
                out.append(json.dumps({"answer": h[:8]}))
            else:
                out.append(f"answer {h[:8]}")
        return out

    def chat(self, conversations: list[list[dict[str, str]]]) -> list[str | None]:
        return self.generate(["\n".join(f"{m['role']}: {m['text']}" for m in c) for c in conversations])


class StubToolModel(StubModel):
    """Answers with a fenced function-calling example; the call of every fourth names another function."""

    def generate(self, prompts: list[str]) -> list[str | None]:
        out: list[str | None] = []
        for p in prompts:
            h = hashlib.md5(p.encode()).hexdigest()
            name = f"f_{h[:4]}"
            function = {"name": name, "parameters": {"type": "object", "required": ["x"]}}
            call = {"function_name": name if int(h, 16) % 4 else "other", "arguments": {"x": h[4:8]}}
            out.append("```json\n" + json.dumps({"question": f"question {h[:8]}", "function": [function], "input_parameters": [call]}) + "\n```")
        return out


class HttpModel:
    """A model behind the usual HTTP interface for chat completions. The key is read from the environment variable named."""

    ROLES = {"system": "system", "human": "user"}

    def __init__(self, url: str, model: str, key_variable: str = "MODEL_API_KEY", temperature: float = 1.2, seconds: float = 120) -> None:
        self.url, self.model, self.key_variable, self.temperature, self.seconds = url, model, key_variable, temperature, seconds

    def chat(self, conversations: list[list[dict[str, str]]]) -> list[str | None]:
        out: list[str | None] = []
        for c in conversations:
            body = {"model": self.model, "temperature": self.temperature, "messages": [{"role": self.ROLES.get(m["role"], "assistant"), "content": m["text"]} for m in c]}
            headers = {"Content-Type": "application/json", "Authorization": f"Bearer {os.environ.get(self.key_variable, '')}"}
            request = urllib.request.Request(self.url, json.dumps(body).encode(), headers)
            with urllib.request.urlopen(request, timeout=self.seconds) as answer:
                out.append(json.load(answer)["choices"][0]["message"]["content"])
        return out

    def generate(self, prompts: list[str]) -> list[str | None]:
        return self.chat([[{"role": "human", "text": p}] for p in prompts])


def _answers(call: Callable[[list], list], asked: list, tries: int) -> list[tuple[str | None, str | None]]:
    """(answer, error) of each prompt. A call for several that fails is repeated one by one, so none spoils the others."""
    done: list[tuple[str | None, str | None]] = [(None, None) for _ in asked]
    together = [i for i, p in enumerate(asked) if p is not None]
    left = dict.fromkeys(together, tries)
    apart = False
    while together:
        for group in [[i] for i in together] if apart else [together]:
            failed = False
            try:
                answers, error = call([asked[i] for i in group]), "no answer"
            except Exception as e:  # noqa: BLE001
                answers, error, failed = [None] * len(group), f"{type(e).__name__}: {e}"[:500], True
            apart |= failed and len(group) > 1
            for i, answer in zip(group, answers, strict=True):
                done[i] = (answer, None if answer is not None else error)
                left[i] -= not failed or len(group) == 1
        together = [i for i in together if done[i][0] is None and left[i] > 0]
    return done


def _caller(make: Callable[[], ModelClient], tries: int, clients: int, size: int, method: str) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Prompts in groups of ``size`` to a pool of ``clients``, each used by one thread at a time; answers in their order."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool_of: Queue = Queue()
        for _ in range(clients):
            pool_of.put(make())

        def some(asked: list) -> list[tuple[str | None, str | None]]:
            client = pool_of.get()
            try:
                return _answers(getattr(client, method), asked, tries)
            finally:
                pool_of.put(client)

        with ThreadPoolExecutor(clients) as pool:
            for batch in batches:
                asked = batch.column(batch.num_columns - 1).to_pylist()
                done = [d for part in pool.map(some, [asked[i : i + size] for i in range(0, len(asked), size)]) for d in part]
                kept = [batch.column(k) for k in range(batch.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array([a for a, _ in done], pa.string()), pa.array([e for _, e in done], pa.string())], names=[*batch.schema.names[:-1], "answer", "error"])

    return run


def ask(df: DataFrame, prompt: Column, make: Callable[[], ModelClient] = StubModel, tries: int = 20, clients: int = 4, size: int = 4, method: str = "generate") -> DataFrame:
    """``df`` with answer and error: ``clients`` per Python worker, prompts in groups of ``size``, null after ``tries``
    failures, null prompts not asked."""
    schema = T.StructType([*df.schema.fields, T.StructField("answer", T.StringType()), T.StructField("error", T.StringType())])
    return df.withColumn("_prompt", prompt).mapInArrow(_caller(make, tries, clients, size, method), schema)


def chat(df: DataFrame, messages: Column, make: Callable[[], ModelClient] = StubModel, tries: int = 20, clients: int = 4) -> DataFrame:
    """``df`` with answer and error to conversations: arrays of struct(role, text), roles other than system and human are ai."""
    known = F.transform(messages, lambda m: F.struct(chat_role(m["role"]).alias("role"), F.coalesce(m["text"], F.lit("")).alias("text")))
    return ask(df, known, make, tries, clients, 1, "chat")


def ask_template(df: DataFrame, template: str, values: dict[str, Column], make: Callable[[], ModelClient] = StubModel, tries: int = 20) -> DataFrame:
    return ask(df, render(template, values), make, tries)


def strict_bool(answer: Column) -> Column:
    """True or False if the answer is exactly that, else null."""
    return F.when(answer == "True", True).when(answer == "False", False)


def loose_bool(answer: Column) -> Column:
    """True if the answer holds "True", else False."""
    return F.coalesce(F.contains(answer, F.lit("True")), F.lit(False))


def one_of(answer: Column, allowed: list[str], default: str) -> Column:
    """The answer if it is allowed, else ``default``."""
    return F.when(answer.isin(*allowed), answer).otherwise(default)


def vote(df: DataFrame, key: str, prompt: Column, times: int = 3, make: Callable[[], ModelClient] = StubModel) -> DataFrame:
    """(key, verdict): the majority of ``times`` yes-or-no answers, a tie is yes."""
    asked = ask(df.select(key, prompt.alias("_p"), F.explode(F.sequence(F.lit(1), F.lit(times))).alias("vote_no")), F.concat(F.col("_p"), F.lit("\n#"), F.col("vote_no").cast("string")), make)
    yes = F.sum(loose_bool(F.col("answer")).cast("int"))
    return asked.groupBy(key).agg((yes * 2 >= F.count("*")).alias("verdict"))


def branch(df: DataFrame, condition: Column, then: Callable[[DataFrame], DataFrame], otherwise: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Rows where ``condition`` holds go through one step, the others through the other: a model is asked only where it is needed."""
    hit = F.coalesce(condition, F.lit(False))
    return then(df.where(hit)).unionByName(otherwise(df.where(~hit)))


def new_nodes(df: DataFrame, labels: str, condition: Column, prompt: Column, make: Callable[[], ModelClient] = StubModel) -> DataFrame:
    """``df`` with answer: what the model makes of a row's labels, or its condition where there are none, unasked."""
    empty = F.coalesce(F.size(labels), F.lit(0)) <= 0
    return branch(df, empty, lambda d: d.withColumn("answer", condition), lambda d: ask(d, prompt, make).drop("error"))


def accept_example(answer: str) -> str | None:
    """The question of a generated function-calling example, None unless its first call is valid for its first function."""
    fenced = answer.replace("```json", "").replace("```", "")
    try:
        example = json.loads(fenced)
        function, call = example["function"][0], example["input_parameters"][0]
        good = function["name"] == call["function_name"] and all(r in call["arguments"] for r in function["parameters"]["required"])
        return example["question"] if good and isinstance(example["question"], str) else None
    except (ValueError, KeyError, TypeError, IndexError):
        return None


def grow(df: DataFrame, key: str, function: str, question: str, template: str, wanted: int = 30, tries: int = 5, make: Callable[[], ModelClient] = StubToolModel, accept: Callable[[str], str | None] = accept_example) -> DataFrame:
    """(key, example_no, attempt, question, answer): up to ``wanted`` more examples for each row's function.

    Each prompt fills {function} and {questions} of ``template``, the latter with the numbered questions
    accepted so far, that of the row first; its attempt is marked on a last line, as prompts may repeat.
    An example is tried until one is accepted, ``tries`` times at most. A function's prompts depend on
    each other, so they are asked in turn; the functions of a batch are asked side by side.
    """
    kind = df.schema[key].dataType
    schema = T.StructType([T.StructField(key, kind), T.StructField("example_no", T.IntegerType()), T.StructField("attempt", T.IntegerType()), T.StructField("question", T.StringType()), T.StructField("answer", T.StringType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = make()
        for batch in batches:
            functions = batch.column(1).to_pylist()
            history = [[q or ""] for q in batch.column(2).to_pylist()]
            found: list[tuple[int, int, int, str, str]] = []
            for number in range(wanted):
                waiting = list(range(batch.num_rows))
                for attempt in range(tries):
                    if not waiting:
                        break
                    filled = [template.replace("{function}", functions[i] or "").replace("{questions}", "\n".join(f"{k}. {q}" for k, q in enumerate(history[i]))) + f"\n#{attempt}" for i in waiting]
                    answers = [a for a, _ in _answers(client.generate, filled, 1)]
                    taken = {i: (q, a) for i, a in zip(waiting, answers, strict=True) if a is not None and (q := accept(a)) is not None}
                    for i, (q, a) in taken.items():
                        history[i].append(q)
                        found.append((i, number, attempt, q, a))
                    waiting = [i for i in waiting if i not in taken]
            at = pa.array([f[0] for f in found], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), *(pa.array([f[k] for f in found], t) for k, t in ((1, pa.int32()), (2, pa.int32()), (3, pa.string()), (4, pa.string())))], names=schema.names)

    return df.select(key, function, question).mapInArrow(run, schema)


class HashEmbedder:
    """Vectors of hashed character trigrams, the same everywhere: a stand-in for an embedding model."""

    dim = 64

    def embed(self, texts: list[str]) -> list[list[float]]:
        out = []
        for t in texts:
            p = np.frombuffer(t.ljust(3, "\0").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
            h = (p[:-2] << np.uint64(42) | p[1:-1] << np.uint64(21) | p[2:]) * np.uint64(0x9E3779B97F4A7C15)
            sign = np.where(h >> np.uint64(63), 1.0, -1.0)
            out.append(np.bincount((h >> np.uint64(40)).astype(np.int64) % self.dim, sign, minlength=self.dim).tolist())
        return out


def embed(self, texts: list[str]) -> list[list[float]]:
        out = []
        for t in texts:
            v = [0.0] * self.dim
            for i in range(max(1, len(t) - 2)):
                h = int.from_bytes(hashlib.md5(t[i : i + 3].encode()).digest()[:4], "big")
                v[h % self.dim] += 1.0 if h & 0x80000000 else -1.0
            out.append(v)
        return out


def embed(df: DataFrame, text: str, make: Callable[[], object] = HashEmbedder) -> DataFrame:
    """``df`` with vector array<float>: one embedder per Python worker, a batch at a time; null texts have no vector."""
    schema = T.StructType([*df.schema.fields, T.StructField("vector", T.ArrayType(T.FloatType()))])
    at = df.columns.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = make()
        for batch in batches:
            texts = batch.column(at).to_pylist()
            vectors = iter(client.embed([t for t in texts if t is not None]))
            column = pa.array([None if t is None else next(vectors) for t in texts], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, "vector"])

    return df.mapInArrow(run, schema)


class StubRecogniser:
    """Reads an image's bytes as lines of text, each with the score 1; bytes that are no text have none."""

    def lines(self, images: list[bytes]) -> list[list[tuple[str, float]]]:
        out = []
        for raw in images:
            try:
                out.append([(t, 1.0) for t in raw.decode("utf-8").split("\n") if t])
            except UnicodeDecodeError:
                out.append([])
        return out


def recognise(df: DataFrame, image: str, make: Callable[[], object] = StubRecogniser, size: int = 8) -> DataFrame:
    """``df`` without the image, a row per recognised line: seq (from 0), text and score. One recogniser per Python worker,
    ``size`` images at a time; images without a line, and null ones, have no row."""
    kept = [f for f in df.schema.fields if f.name != image]
    schema = T.StructType([*kept, T.StructField("seq", T.IntegerType()), T.StructField("text", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = make()
        for batch in batches:
            raw = batch.column(batch.num_columns - 1).to_pylist()
            there = [i for i, r in enumerate(raw) if r is not None]
            found = [(i, k, *line) for a in range(0, len(there), size) for i, lines in zip(there[a : a + size], client.lines([raw[j] for j in there[a : a + size]]), strict=True) for k, line in enumerate(lines)]
            at = pa.array([f[0] for f in found], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(at) for c in range(len(kept))), pa.array([f[1] for f in found], pa.int32()), pa.array([f[2] for f in found], pa.string()), pa.array([f[3] for f in found], pa.float64())], names=schema.names)

    return df.select(*[f.name for f in kept], image).mapInArrow(run, schema)
