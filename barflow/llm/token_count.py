"""Token counts by a map-side two-tier lookup; no pre-token is ever shuffled.

Tier one is a compact table from pre-token to number of tokens, broadcast. Its
entries are the vocabulary's own strings: what training merged into one entry
is what texts repeat most. It depends on the tokenizer alone and never holds
more entries than the vocabulary, so its size is bounded whatever the corpus.
Tier two is a bounded cache in each Python worker, which encodes the misses and
outlives the task. Counts come out of the row's own task, exact for every text.

Defined results: null text counts as empty (0 tokens); repeated rows are
counted each; empty tables give no rows; other columns travel in ``row``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.llm.byte_bpe import PreTokens, Units, load_tokenizer, splits_at_spaces
from barflow.llm.shared import packed, require

# One counter per tokenizer file for the life of a worker.
_COUNTERS: dict[str, Counter] = {}


def frequent_lengths(path: str) -> dict[str, int]:
    """Tokens of each vocabulary string taken as a pre-token (in the byte alphabet)."""
    tokenizer = load_tokenizer(path)
    return {word: len(tokenizer.model.tokenize(word)) for word in tokenizer.get_vocab(with_added_tokens=False)}


class Counter:
    """Counts the tokens of texts as the library does."""

    def __init__(self, path: str, frequent: dict[str, int]) -> None:
        self.tokenizer = load_tokenizer(path)
        self.frequent = frequent
        self.fast = splits_at_spaces(self.tokenizer)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        if self.fast:
            self.pre_tokens = PreTokens(self.tokenizer)
            self.units = Units(self._unit)

    def _unit(self, text: str) -> int:
        total = 0
        for pre_token in self.pre_tokens(text):
            known = self.frequent.get(pre_token)
            total += len(self.tokenizer.model.tokenize(pre_token)) if known is None else known
        return total

    def count(self, text: str) -> int:
        if not text:
            return 0
        if not self.fast or any(token in text for token in self.added):
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return sum(self.units.of(text))


class Pieces:
    """The same for a sentencepiece model, which keeps no pre-tokens apart."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)

    def count(self, text: str) -> int:
        return len(self.model.encode(text, num_threads=1)) if text else 0


def token_counts(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """``row`` (the other columns), n_bytes and n_tokens.

    ``tokenizer`` is the path of a ``.json`` or ``.model`` file that all machines
    have at the same place.
    """
    require(docs, text)
    pieces = tokenizer.endswith(".model")
    known = docs.sparkSession.sparkContext.broadcast({} if pieces else frequent_lengths(tokenizer))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _COUNTERS.get(tokenizer)
        if counter is None:
            counter = Pieces(tokenizer) if pieces else Counter(tokenizer, known.value)
            _COUNTERS[tokenizer] = counter
        for batch in batches:
            texts = batch.column(1)
            n_tokens = pa.array([counter.count(t.as_py()) for t in texts], pa.int64())
            n_bytes = pa.array([t.as_buffer().size if t.is_valid else 0 for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), n_bytes, n_tokens], ["row", "n_bytes", "n_tokens"])

    rest = docs.drop(text)
    row = packed(rest) if rest.columns else F.struct(F.lit(None).cast("string").alias("none"))
    rows = docs.select(row.alias("row"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(counted, f"row {kind}, n_bytes bigint, n_tokens bigint")
