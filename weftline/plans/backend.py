"""Inference backends, and the one place where rows meet a model."""

from __future__ import annotations

import json
import os
import re
import time
from concurrent.futures import ThreadPoolExecutor
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import jsonx


class Backend(Protocol):
    def complete(self, prompts: list[str], settings: list[dict]) -> list[tuple[str, str]]:
        """(text, error) of each prompt; settings hold temperature, top_p and max_tokens."""


class StubBackend:
    """Deterministic stand-in for a model: works on the product of the first two numbers of the prompt's question line.

    On a first attempt it answers without JSON where the numbers add up to a multiple
    of three.  An audit holds answer and steps against the product.
    """

    def complete(self, prompts: list[str], settings: list[dict]) -> list[tuple[str, str]]:
        return [(self.one(p), "") for p in prompts]

    def one(self, prompt: str) -> str:
        lines = prompt.split("\n")
        field = lambda name: next((x.split(": ", 1)[1] for x in lines if x.startswith(name + ": ")), "")
        question = field("Question")
        a, b = ([int(x) for x in re.findall(r"\d+", question)] + [1, 1])[:2]
        if field("Attempt") == "0" and (a + b) % 3 == 0:
            return "no json here"
        ok = {"verdict": "pass", "issues": [], "repair_suggestions": [], "short_reason": "fine"}
        steps = [f"Step 1: Given the numbers, {a} * {b} = {a * b}."]
        kind = lines[0].removeprefix("Task: ")
        if kind == "audit":
            right, shown = jsonx.answer_of(field("Answer")) == str(a * b), re.search(rf"(?<!\d){a * b}(?!\d)", field("Steps")) is not None
            good = right and shown
            out = {"question_valid": True, "solvable": True, "unique_answer": True, "answer_correct": right, "steps_correct": shown, "difficulty_match": True, "estimated_difficulty": field("Difficulty")}
            out |= {"error_type": "none" if good else "answer_mismatch", "repair_action": "pass" if good else "repair_solution"}
        elif kind == "score":
            n = sum(x.startswith("Step ") for x in lines)
            out = {k: [1.0] * n for k in jsonx.DIMENSIONS} | {"final_answer_correct": True}
        elif kind == "answer":
            out = {"steps": [f"{a} * {b} = {a * b}"], "final_answer": str(a * b)}
        elif kind in ("inspect", "evaluate"):
            out = ok | {"scores": dict.fromkeys(("difficulty_match", "correctness", "answer_uniqueness", "step_validity", "brevity", "non_redundancy", "answer_quality"), 5)}
        else:
            out = {"question": jsonx.ws(question), "steps": steps, "solution": steps[0], "answer": str(a * b), "solvable": True, "unique_answer": True, "confidence": 0.9}
        return json.dumps(out)


def model_names(name: str) -> set[str]:
    """What a served model may be called: its name, its whole path, and the path's last part."""
    bare = name.strip().rstrip("/")
    return {n for n in (name.strip(), bare, os.path.basename(bare)) if n}


class HttpBackend:
    """An OpenAI-compatible chat endpoint; many requests at a time, waits between tries, the served name looked up once.

    ``retries`` below 0 tries for ever.  What stays without an answer comes back as an error.
    """

    def __init__(self, url: str, model: str, timeout: float = 600, retries: int = 3, concurrency: int = 32, force_json: bool = True, thinking: bool = False, key: str = ""):
        self.url, self.model, self.timeout, self.retries, self.concurrency = url.rstrip("/"), model, timeout, retries, concurrency
        self.force_json, self.thinking, self.key, self.served = force_json, thinking, key, None

    def _call(self, path: str, body: dict | None = None) -> dict:
        import urllib.request

        data = None if body is None else json.dumps(body).encode()
        headers = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {self.key}"} if self.key else {})
        with urllib.request.urlopen(urllib.request.Request(f"{self.url}/{path}", data, headers), timeout=self.timeout) as answer:
            return json.load(answer)

    def served_name(self) -> str:
        """The name under which the endpoint serves the model, or the given one."""
        wanted = model_names(self.model)
        served = [m.get("id", "") for m in self._call("models").get("data", [])]
        return next((s for s in served if model_names(s) & wanted), served[0] if len(served) == 1 else self.model)

    def _one(self, prompt: str, setting: dict) -> tuple[str, str]:
        turn, looked_up = 0, False
        while True:
            body = {"model": self.served or self.model, "messages": [{"role": "user", "content": prompt}], **setting}
            body |= {"response_format": {"type": "json_object"}} if self.force_json else {}
            body |= {} if self.thinking else {"chat_template_kwargs": {"enable_thinking": False}}
            try:
                return self._call("chat/completions", body)["choices"][0]["message"]["content"] or "", ""
            except (OSError, ValueError, KeyError, IndexError, TypeError) as fault:
                if getattr(fault, "code", None) == 404 and not looked_up:
                    looked_up = True
                    try:
                        self.served = self.served_name()
                        continue
                    except (OSError, ValueError):
                        pass
                if turn == self.retries:
                    return "", f"{type(fault).__name__}: {fault}"
                turn += 1
                time.sleep(min(3 * turn, 15))

    def complete(self, prompts: list[str], settings: list[dict]) -> list[tuple[str, str]]:
        with ThreadPoolExecutor(max(1, min(self.concurrency, len(prompts)))) as pool:
            return list(pool.map(self._one, prompts, settings))


def infer(df: DataFrame, prompt: Column, backend: Backend, temperature=0.0, top_p=0.9, max_tokens=1200) -> DataFrame:
    """Adds the backend's text (raw) and error (request_error) for each row's prompt; the settings may be columns.

    Only prompts and settings go to Python; all else of a row stays in the JVM.
    """
    as_column = lambda x, kind: (x if isinstance(x, Column) else F.lit(x)).cast(kind)

    def run(prompts: pd.Series, temperatures: pd.Series, tops: pd.Series, most: pd.Series) -> pd.DataFrame:
        settings = [{"temperature": t, "top_p": p, "max_tokens": int(m)} for t, p, m in zip(temperatures, tops, most)]
        replies = backend.complete(prompts.tolist(), settings)
        return pd.DataFrame({"raw": pd.Series([r[0] for r in replies], dtype=object), "request_error": pd.Series([r[1] for r in replies], dtype=object)})

    call = F.pandas_udf(run, "raw string, request_error string").asNondeterministic()
    asked = df.withColumn("_reply", call(prompt, as_column(temperature, "double"), as_column(top_p, "double"), as_column(max_tokens, "int")))
    return asked.select(*df.columns, "_reply.raw", "_reply.request_error")
