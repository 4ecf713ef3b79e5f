"""The command facade: tables by name, corpora and models by path, five commands and the expander."""

from __future__ import annotations

import os
import shlex

from pyspark.sql import DataFrame, SparkSession

from lexivane.operators import expander
from lexivane.operators.corpus import dump_corpus
from lexivane.operators.distance import Result, distance
from lexivane.operators.model import Registry
from lexivane.operators.train import train
from lexivane.operators.vocab import read_vocab, save_vocab
from lexivane.sources import model_io

#: The commands' arguments by position.
ARGUMENTS = {
    "dump_to_train_file": "table column filter train_file normalizer input_filter mecab_option sentence_vectors".split(),
    "word2vec_train": "train_file output_file save_vocab_file read_vocab_file threads size debug binary cbow alpha window sample hs negative iter min_count classes is_output_file sentence_vectors".split(),
    "word2vec_load": "file_path binary".split(),
    "word2vec_unload": [],
    "word2vec_distance": "term offset limit n_sort threshold normalizer prefix_filter stop_filter output_filter mecab_option file_path binary expander_mode is_phrase edit_distance pca pca_centered sentence_vectors table column sortby".split(),
}


class Engine:
    """`with Engine(spark, workspace, tables) as e: e.run('word2vec_distance "a + b" --limit 3')`"""

    def __init__(self, spark: SparkSession, workspace: str, tables: dict[str, DataFrame] | None = None, id_col: str = "_id", compat: bool = False, tokenizer=None, train_mode: str = "auto"):
        """train_mode: how word2vec_train makes vectors; "init" leaves the seeded ones, as where a corpus is too small for its workers to begin."""
        self.spark, self.workspace, self.tables, self.id_col, self.compat, self.tokenizer, self.train_mode = spark, workspace.rstrip("/"), dict(tables or {}), id_col, compat, tokenizer, train_mode
        self.registry = Registry()

    def __enter__(self) -> "Engine":
        return self

    def __exit__(self, *_) -> None:
        self.registry.unload_all()

    def path(self, name: str | None, suffix: str) -> str:
        return f"{self.workspace}/{name}" if name and "/" not in name and ":" not in name else name or f"{self.workspace}/corpus{suffix}"

    def run(self, line: str):
        """One command line: positional arguments in their order, others as --name value."""
        words = shlex.split(line)
        if not words or words[0] not in ARGUMENTS:
            raise ValueError(f"unknown command: {line!r}")
        names, given, rest = ARGUMENTS[words[0]], {}, []
        at = 1
        while at < len(words):
            if words[at].startswith("--") and words[at][2:] in names:
                given[words[at][2:]] = words[at + 1] if at + 1 < len(words) else ""
                at += 2
            else:
                rest.append(words[at])
                at += 1
        free = [n for n in names if n not in given]
        given |= dict(zip(free, rest))
        return getattr(self, words[0])(**given)

    def dump_to_train_file(self, table=None, column=None, filter=None, train_file=None, normalizer=None, input_filter=None, mecab_option=None, sentence_vectors=None) -> bool:
        if not table or not column:
            raise ValueError("table and column are needed")
        corpus = dump_corpus(self.tables[table], column, filter, self.id_col, normalizer or "auto", input_filter, None if mecab_option == "NONE" else self.tokenizer, _on(sentence_vectors))
        model_io.write_corpus(corpus, self.path(train_file, "_w2v.txt"))
        return True

    def word2vec_train(self, train_file=None, output_file=None, save_vocab_file=None, read_vocab_file=None, threads=None, size=None, debug=None, binary="1", cbow="0", alpha=None, window=None, sample=None, hs="1", negative="0", iter=None, min_count=None, classes=None, is_output_file=None, sentence_vectors=None) -> bool:
        corpus = model_io.read_corpus(self.spark, self.path(train_file, "_w2v.txt"))
        vocab = read_vocab(self.spark, self.path(read_vocab_file, "")) if read_vocab_file else None
        options = {k: kind(v) for k, kind, v in (("threads", int, threads), ("size", int, size), ("alpha", float, alpha), ("window", int, window), ("sample", float, sample), ("iter", int, iter), ("min_count", int, min_count), ("classes", int, classes)) if v}
        # Any value given, even 0, keeps every word, as with the option itself.
        made = train(corpus, hs=int(hs), negative=int(negative), cbow=int(cbow), sentence_vectors=bool(sentence_vectors), vocab=vocab, mode=self.train_mode, **options)
        if save_vocab_file:
            save_vocab(made.vocab, self.path(save_vocab_file, ""))
        out = self.path(output_file, "_w2v.bin")
        if made.classes is not None:
            made.classes.orderBy("word_id").selectExpr("concat_ws(' ', word, class) AS value").coalesce(1).write.mode("overwrite").text(out)
        elif _on(binary):
            model_io.write_binary(made.vectors, out)
        else:
            model_io.write_text(made.vectors, out)
        return True

    def word2vec_load(self, file_path=None, binary="1") -> bool:
        return self.registry.load(self.spark, self.path(file_path, "_w2v.bin"), _on(binary))

    def word2vec_unload(self) -> bool:
        return self.registry.unload_all()

    def word2vec_distance(self, term=None, offset=0, limit=10, n_sort=40, threshold=-1, normalizer=None, prefix_filter=None, stop_filter=None, output_filter=None, mecab_option=None, file_path=None, binary="1", expander_mode=None, is_phrase=None, edit_distance=None, pca=0, pca_centered="1", sentence_vectors=None, table=None, column=None, sortby=None) -> Result:
        model = self.registry.get(self.spark, self.path(file_path, "_w2v.bin"), _on(binary))
        return distance(model.df, term or "", int(offset), int(limit), int(n_sort), float(threshold), normalizer or "auto", prefix_filter, stop_filter, output_filter, _on(is_phrase), _on(edit_distance), int(pca), _on(pca_centered), _on(sentence_vectors), self.tables[table] if table else None, self.id_col, column, sortby, _on(expander_mode), self.compat, None if mecab_option in (None, "NONE") else self.tokenizer)

    def expand(self, term: str, file_path=None, binary="1") -> str:
        """The expander function; threshold and limit come from the environment if they are set there."""
        model = self.registry.get(self.spark, self.path(file_path, "_w2v.bin"), _on(binary))
        return expander.expand_query(model.df, term, float(os.environ.get("LEXIVANE_EXPANDER_THRESHOLD", expander.THRESHOLD)), int(os.environ.get("LEXIVANE_EXPANDER_LIMIT", expander.LIMIT)), self.compat)


def _on(value) -> bool:
    return value not in (None, "", "0", 0, False)
