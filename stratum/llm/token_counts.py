"""Token counts with a whole-token shortcut.

For a sentence-piece model whose pieces hold the space mark only at their
front and hold no line break, no merge can cross the place where a non-space
is followed by a space, nor a line break. Those places cut a text into
pre-tokens that encode independently. ``WholeTokens`` proves offline, from the
model file alone, that the cuts are safe and which vocabulary strings encode
alone as exactly one token. While counting, a pre-token of that set counts as
one without being merged, in memory-bounded memos; only the rest goes through
the library's merges.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import BooleanType, LongType, StructField

from stratum.llm.common import map_texts, table

MARK = "▁"
#: pre-tokens whose counts a task remembers; beyond it the memo starts anew
MEMO = 300_000


class WholeTokens:
    """Counter for one model file."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.safe_cuts = self._prove_cuts(pieces)
        self.whole = self._prove_whole(pieces) if self.safe_cuts else frozenset()
        self.memo: dict[str, int] = {}
        self.break_tokens = len(self.model.encode("\n"))
        self.cut = re.compile(r" *[^ \n]+| +|\n")

    def _prove_cuts(self, pieces: list[str]) -> bool:
        """No piece holds a space mark after another character or a line break,
        and the model maps text to itself but for the spaces."""
        probe = " Éa  b\t\nﬁ ①x "
        kept = self.model.normalize(probe) == MARK + probe.replace(" ", MARK)
        return kept and not any(MARK in p.lstrip(MARK) or "\n" in p for p in pieces)

    def _prove_whole(self, pieces: list[str]) -> frozenset[str]:
        """Strings of the vocabulary, as they stand in a text, that encode to one
        token when they stand alone between cuts."""
        led = [p[1:] for p in pieces if p.startswith(MARK) and p.strip(MARK)]
        bare = [p for p in pieces if MARK not in p]
        ids = self.model.encode([*(p.replace(MARK, " ") for p in led), *("\n" + p for p in bare)])
        alone = self.model.encode("\n")
        whole = {" " + p.replace(MARK, " ") for p, got in zip(led, ids) if len(got) == 1}
        whole |= {p for p, got in zip(bare, ids[len(led):])
                  if len(got) == len(alone) + 1 and "\n" not in p}
        return frozenset(whole)

    def _merge(self, rest: list[str]) -> None:
        """Counts of pre-tokens that are not one token, by the library's merges.
        A pre-token led by a space takes the mark that the model puts in front of
        a text; any other is put behind a line break, which merges with nothing."""
        ask = [r[1:] if r[0] == " " else "\n" + r for r in rest]
        for r, a, got in zip(rest, ask, self.model.encode(ask, num_threads=1)):
            if r == " ":
                self.memo[r] = 1  # the mark alone
            else:
                self.memo[r] = len(got) - (0 if r[0] == " " else self.break_tokens)

    def counts(self, texts: list[str]) -> list[int]:
        if not self.safe_cuts:
            return [len(x) for x in self.model.encode(texts, num_threads=1)]
        out = []
        for text in texts:
            if not text:
                out.append(0)
                continue
            if len(self.memo) > MEMO:
                self.memo.clear()
            if not self.memo:
                self.memo.update(dict.fromkeys(self.whole, 1))
                self.memo["\n"] = self.break_tokens - 1
            parts = self.cut.findall(" " + text.replace(MARK, " "))
            new = set(parts).difference(self.memo)
            if new:
                self._merge(list(new))
            out.append(sum(map(self.memo.__getitem__, parts)))
        return out


@lru_cache(maxsize=2)
def counter(path: str) -> WholeTokens:
    return WholeTokens(path)


def token_counts(df: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row.

    Null and empty texts have 0 bytes and 0 tokens; null ids, repeated rows and
    ties stay rows of their own; extra columns are not carried; an empty table
    gives an empty result. Whole texts are counted, at any length."""
    def setup():
        whole = counter(model_path)

        def score(texts):
            n = whole.counts(texts)
            return [[len(t.encode()) for t in texts], n, [x > limit for x in n]]
        return score

    return map_texts(df, setup, [StructField("n_bytes", LongType()), StructField("n_tokens", LongType()),
                                 StructField("over_limit", BooleanType())], id_col, text_col)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"),
                        public_tokenizers.path("piece_bpe_32k.model"))
