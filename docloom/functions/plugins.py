"""What a user may replace: parsers, OCR, language detection, summaries, embeddings.

Each is an object with one method over lists; lift_* makes it a column. The defaults need no network and
no model, and give the same result each time; they don't claim to match any model's output.
"""

from __future__ import annotations

import json
import logging
import re
import time
import zlib
from collections import Counter
from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom.functions import text as T


#: Texts that a summarizer is given at a time.
TEXTS = 256


class LanguageDetector(Protocol):
    def detect(self, texts: list[str]) -> list[str]: ...


class Summarizer(Protocol):
    def summarize(self, texts: list[str]) -> list[tuple[str, list[str]]]: ...


class Embedder(Protocol):
    dim: int

    def embed(self, texts: list[str]) -> np.ndarray: ...


class Completer(Protocol):
    def complete(self, prompts: list[str]) -> list[str]: ...


class OcrBackend(Protocol):
    def read(self, contents: list[bytes]) -> list[str]: ...


class TreeProposer(Protocol):
    def propose(self, tags: list[str]) -> dict: ...


def failed(what: str, n: int, error: Exception) -> None:
    """What a plug-in couldn't do becomes its empty answer and a line in the log of the process it ran in."""
    logging.getLogger(__name__).warning("%s of %d rows failed: %s: %s", what, n, type(error).__name__, error)


def propose_tree(tags: list[str], proposer: TreeProposer) -> dict:
    """A nested taxonomy of the tags, as the proposer gives it; empty where it fails."""
    try:
        return proposer.propose(sorted(set(tags)))
    except Exception as e:
        failed("tag tree", len(tags), e)
        return {}


#: Frequent words of each language.
FREQUENT = {
    "de": "der die das und ist nicht ein eine mit von zu den im für auf sich dem des auch als".split(),
    "en": "the and of to is in that it with for on was are as be this by not from at".split(),
    "es": "el la de que y en los se del las por con una para es no su al lo como".split(),
    "fr": "le la les de et un une des est que qui dans pour pas sur au avec ce il du".split(),
    "sk": "a je na sa v že to pre ako s alebo nie pri podľa z o do ktorý by žiadosť".split(),
}


class StopWordDetector:
    """The language whose frequent words are most of the text; "unknown" without any."""

    def detect(self, texts: list[str]) -> list[str]:
        out = []
        for text in texts:
            words = Counter(re.findall(r"\w+", (text or "").lower()))
            score = {lang: sum(words[w] for w in frequent) for lang, frequent in sorted(FREQUENT.items())}
            best = max(score, key=score.get)
            out.append(best if score[best] else "unknown")
        return out


class NullSummarizer:
    """What a failed call gives: no summary, no tags."""

    def summarize(self, texts: list[str]) -> list[tuple[str, list[str]]]:
        return [("", []) for _ in texts]


class ExtractiveSummarizer:
    """First sentence as summary, most frequent longer words as tags."""

    def __init__(self, tags: int = 5):
        self.tags = tags

    def summarize(self, texts: list[str]) -> list[tuple[str, list[str]]]:
        out = []
        for text in texts:
            text = text or ""
            first = re.split(r"(?<=[.!?])\s", text.strip(), maxsplit=1)[0][:200]
            words = Counter(w for w in re.findall(r"\w+", text.lower()) if len(w) > 4)
            out.append((first, [w for w, _ in sorted(words.items(), key=lambda x: (-x[1], x[0]))[: self.tags]]))
        return out


def embedder_of(settings) -> Embedder:
    """The embedder that settings name: "hashing", or a model's name or folder with its dimension as "name:768"."""
    if settings.embedder == "hashing":
        return HashingEmbedder()
    name, _, dim = settings.embedder.rpartition(":")
    if not name or not dim.isdigit():
        raise ValueError(f"an embedder is hashing or name:dimension, not {settings.embedder}")
    return ModelEmbedder(name, int(dim), settings.device, settings.batch_size, settings.max_seq_length)


def json_of(reply: str) -> dict:
    """A reply without its code fences as JSON; empty where it is no object."""
    try:
        found = json.loads((reply or "").replace("```json", "").replace("```", "").strip())
    except ValueError:
        return {}
    return found if isinstance(found, dict) else {}


class PromptSummarizer:
    """Summaries and tags of a language model: a prompt for each text, its reply read as JSON.

    Tags may be a list or one string with commas. A reply that is no JSON gives no summary and no tags.
    """

    def __init__(self, completer: Completer, prompt: str = "{text}", summary_key: str = "summary", tags_key: str = "tags"):
        self.completer, self.prompt, self.keys = completer, prompt, (summary_key, tags_key)

    def summarize(self, texts: list[str]) -> list[tuple[str, list[str]]]:
        replies = self.completer.complete([self.prompt.replace("{text}", t or "") for t in texts])
        out = []
        for found in map(json_of, replies):
            summary, tags = (found.get(k) for k in self.keys)
            parts = tags.split(",") if isinstance(tags, str) else tags if isinstance(tags, list) else []
            out.append((str(summary or "").strip(), [x for x in (str(t).strip() for t in parts) if x]))
        return out


class ModelEmbedder:
    """A sentence model by name or local folder, loaded once in each worker, where the library for it is installed.

    The device asked for is used if it is there, else the processor. A model that can't be loaded is an error at once.
    """

    def __init__(self, name: str, dim: int, device: str = "cpu", batch_size: int = 32, max_seq_length: int = 512):
        self.name, self.dim, self.device = name, dim, device
        self.batch_size, self.max_seq_length = batch_size, max_seq_length
        self.model = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"model": None}

    def load(self):
        if self.model is None:
            try:
                from sentence_transformers import SentenceTransformer

                self.model = SentenceTransformer(self.name, device=available_device(self.device))
            except Exception as e:
                raise RuntimeError(f"can't load the model {self.name}: {e}") from e
            self.model.max_seq_length = self.max_seq_length
        return self.model

    def embed(self, texts: list[str]) -> np.ndarray:
        return np.asarray(self.load().encode(texts, batch_size=self.batch_size, show_progress_bar=False))


def available_device(wanted: str) -> str:
    """cuda or mps if asked for and there, else cpu."""
    if wanted == "cpu":
        return wanted
    try:
        import torch

        there = torch.cuda.is_available() if wanted == "cuda" else torch.backends.mps.is_available()
    except ImportError:
        there = False
    if not there:
        logging.getLogger(__name__).warning("device %s isn't available, taking cpu", wanted)
    return wanted if there else "cpu"


class HashingEmbedder:
    """Signed feature hashing of words, length 1; a text without words gives the zero vector."""

    def __init__(self, dim: int = 64):
        self.dim = dim

    def embed(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dim))
        for row, text in zip(out, texts):
            for word in re.findall(r"\w+", (text or "").lower()):
                h = zlib.crc32(word.encode())
                row[h % self.dim] += 1.0 if h & 0x80000000 else -1.0
        size = np.linalg.norm(out, axis=1, keepdims=True)
        return np.divide(out, size, out=out, where=size > 0)


def embedded_batch(embedder: Embedder, texts: list[str], retries: int, delay: float) -> np.ndarray:
    """Vectors of one batch; zeros where the embedder fails, the first time and at every retry."""
    for attempt in range(retries + 1):
        if attempt:
            time.sleep(delay)
        try:
            return np.asarray(embedder.embed(texts), np.float32)
        except Exception as e:
            failed("embedding", len(texts), e)
    return np.zeros((len(texts), embedder.dim), np.float32)


def embed(
    text: Column, embedder: Embedder, keep_zeros: bool = False, batch_size: int = 32, max_retries: int = 0, retry_delay: float = 1.0
) -> Column:
    """Vector of a text, in batches of batch_size; null (or a zero vector with keep_zeros) where embedding a batch fails."""

    @F.pandas_udf("array<float>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            texts = s.fillna("").tolist()
            parts = [embedded_batch(embedder, texts[a : a + batch_size], max_retries, retry_delay) for a in range(0, len(texts), batch_size)]
            table = np.concatenate(parts) if parts else np.zeros((0, embedder.dim), np.float32)
            zero = ~table.any(axis=1)
            yield pd.Series([None if z and not keep_zeros else row for row, z in zip(table, zero)], dtype=object)

    return run(text)


def detect_language(text: Column, detector: LanguageDetector | None = None) -> Column:
    detector = detector or StopWordDetector()

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            try:
                yield pd.Series(detector.detect(s.fillna("").tolist()), dtype=object)
            except Exception as e:
                failed("language detection", len(s), e)
                yield pd.Series(["unknown"] * len(s), dtype=object)

    return run(text)


def summarize(text: Column, summarizer: Summarizer | None = None, chars: int | None = 1000) -> Column:
    """struct(summary, tags) of a text's first characters (None: of all); ("", []) where the summarizer fails.

    A summarizer is given TEXTS texts at a time: beside the batch that Spark sends, a task holds no more.
    """
    summarizer = summarizer or NullSummarizer()

    said = pa.struct([("summary", pa.string()), ("tags", pa.list_(pa.string()))])

    @F.arrow_udf("struct<summary: string, tags: array<string>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for a in range(0, len(batch), TEXTS):
                some = [t or "" for t in batch.slice(a, TEXTS).to_pylist()]
                try:
                    found = summarizer.summarize(some)
                except Exception as e:
                    failed("summary", len(some), e)
                    found = [("", [])] * len(some)
                yield pa.array([{"summary": s, "tags": list(tags)} for s, tags in found], said)

    return run(text if chars is None else F.substring(text, 1, chars))


class MetadataModel:
    """Asks a language model for the metadata of a file: its name and the beginning of its text stand in the prompt."""

    def __init__(self, completer: Completer, prompt: str = "{file_name}\n{snippet}"):
        self.completer, self.prompt = completer, prompt


def describe(name: Column, suffix: Column, snippet: Column, model: MetadataModel, chars: int = 800) -> Column:
    """struct(nazov_suboru, typ_suboru, tagy, sumar) as the model's reply has them; null where it has not, or fails.

    Prompts are made and replies read by expressions; the model sees batches of prompts. {file_name}, {file_type} and
    {snippet} in its prompt are replaced. Tags may be a list or one string with commas.
    """
    completer = model.completer

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            try:
                yield pd.Series(completer.complete(s.tolist()), dtype=object)
            except Exception as e:
                failed("metadata", len(s), e)
                yield pd.Series([None] * len(s), dtype=object)

    filled = lambda prompt, key, value: F.replace(prompt, F.lit(key), F.coalesce(value, F.lit("")))
    prompt = filled(filled(F.lit(model.prompt), "{file_name}", name), "{file_type}", suffix)
    found = T.json_of_reply(run(filled(prompt, "{snippet}", F.substring(snippet, 1, chars))))
    get = lambda reply, key, kind="string": F.try_variant_get(reply, f"$.{key}", kind)
    fields = lambda reply: F.struct(
        get(reply, "nazov_suboru").alias("nazov_suboru"),
        get(reply, "typ_suboru").alias("typ_suboru"),
        F.coalesce(get(reply, "tagy", "array<string>"), T.tags_of(get(reply, "tagy"))).alias("tagy"),
        get(reply, "sumar").alias("sumar"),
    )
    # Bound to a name by a list of one, so that the model is asked once.
    return F.transform(F.array(found), fields)[0]
