"""Words the dictionary lacks, by character tags.

Dictionary segmentation leaves unknown words as runs of single characters. A
model of tags (B begin, M middle, E end of a word, S a word alone) counted from
segmented texts cuts these runs: the most probable tag path by Viterbi, once
per distinct run. A run of one character stays; a run that is a dictionary
word itself is not joined again (the dictionary's path was more probable).

The model is at most four numbers per character of the alphabet, 16 transitions
and 4 starts, so it goes to the tasks whole. Probabilities are
``(count + 1/2) / (total + (outcomes + 1) / 2)``; ties go to the first tag of
B, E, M, S. NULL arrays stay NULL, empty ones empty; without any word in the
training texts all paths are as probable.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featlab.functions.arrays import explode_values
from featlab.session import reliable_checkpoint

TAGS = "BEMS"
#: Which tags may follow, and which may start and end a run.
FOLLOWS = {"B": "EM", "M": "EM", "E": "BS", "S": "BS"}
STARTS, ENDS = "BS", "ES"


@dataclass
class TagModel:
    start: dict = field(default_factory=dict)        # tag -> log probability
    step: dict = field(default_factory=dict)         # (tag, next tag) -> log probability
    emit: dict = field(default_factory=dict)         # (tag, character) -> log probability
    unseen: dict = field(default_factory=dict)       # tag -> log probability of a new character

    def emission(self, tag: str, char: str) -> float:
        return self.emit.get((tag, char), self.unseen[tag])


def fit_tags(texts: DataFrame, words_col: str) -> TagModel:
    """Counts over all texts: (tag, character), (tag, next tag inside a text), first tags. Tags follow
    from the words' lengths, so words are counted first (with what follows them) and only distinct
    ones are taken apart."""
    w = F.filter(words_col, lambda w: w.isNotNull() & (F.length(w) > 0))
    rows = F.transform(F.sequence(F.lit(0), F.size("w") - 1), lambda i: F.struct(
        F.col("w")[i].alias("word"), (F.length(F.get("w", i + 1)) == 1).alias("next_single"), (i == 0).alias("first")))
    words = texts.select(w.alias("w")).filter(F.size("w") > 0).select(explode_values(rows).alias("r")).select("r.*")
    counts = reliable_checkpoint(words.groupBy("word", "next_single", "first").agg(F.count(F.lit(1)).alias("n")))
    size = F.length("word")

    def tag(i: Column) -> Column:
        return F.when(size == 1, "S").when(i == 1, "B").when(i == size, "E").otherwise("M")
    chars = F.transform(F.sequence(F.lit(1), size), lambda i: F.struct(tag(i).alias("tag"), F.substring("word", i, 1).alias("char")))
    emitted = counts.groupBy("word").agg(F.sum("n").alias("n")).select(F.explode(chars).alias("c"), "n").groupBy("c.tag", "c.char") \
        .agg(F.sum("n").alias("n")).collect()   # four rows per character of the alphabet at most
    last, following = F.when(size == 1, "S").otherwise("E"), F.when(F.col("next_single"), "S").otherwise("B")
    inside = counts.filter(size > 1).select(F.explode(F.array(
        F.struct(F.when(size == 2, "BE").otherwise("BM").alias("step"), F.col("n").alias("n")),
        F.struct(F.lit("MM").alias("step"), (F.col("n") * F.greatest(size - 3, F.lit(0))).alias("n")),
        F.struct(F.lit("ME").alias("step"), F.when(size > 2, F.col("n")).otherwise(0).alias("n")))).alias("s")).select("s.*")
    between = counts.filter("next_single is not null").select(F.concat(last, following).alias("step"), "n")
    steps = {r.step: r.n for r in inside.unionByName(between).groupBy("step").agg(F.sum("n").alias("n")).collect()}   # ten rows at most
    starts = {r.tag: r.n for r in counts.filter("first").groupBy(F.when(size == 1, "S").otherwise("B").alias("tag")).agg(F.sum("n").alias("n")).collect()}
    alphabet = len({r.char for r in emitted})
    model = TagModel()

    def log_share(count: float, total: float, outcomes: int) -> float:
        return math.log((count + 0.5) / (total + 0.5 * (outcomes + 1)))
    for tag in TAGS:
        total = sum(r.n for r in emitted if r.tag == tag)
        model.unseen[tag] = log_share(0, total, alphabet)
        for r in emitted:
            if r.tag == tag:
                model.emit[tag, r.char] = log_share(r.n, total, alphabet)
        out = sum(steps.get(tag + b, 0) for b in FOLLOWS[tag])
        for b in FOLLOWS[tag]:
            model.step[tag, b] = log_share(steps.get(tag + b, 0), out, len(FOLLOWS[tag]))
    for tag in STARTS:
        model.start[tag] = log_share(starts.get(tag, 0), sum(starts.values()), len(STARTS))
    return model


def best_tags(run: str, model: TagModel) -> str:
    """The most probable tags of a run of characters (Viterbi)."""
    score = {t: model.start[t] + model.emission(t, run[0]) for t in STARTS}
    back: list[dict[str, str]] = []
    for c in run[1:]:
        came: dict[str, str] = {}
        new: dict[str, float] = {}
        for a in TAGS:
            if a not in score:
                continue
            for b in FOLLOWS[a]:
                s = score[a] + model.step[a, b] + model.emission(b, c)
                if b not in new or s > new[b]:
                    new[b], came[b] = s, a
        back.append(came)
        score = new
    tag = max((t for t in ENDS if t in score), key=lambda t: score[t])
    out = [tag]
    for came in reversed(back):
        tag = came[tag]
        out.append(tag)
    return "".join(reversed(out))


def cut_by_tags(run: str, tags: str) -> list[str]:
    words: list[str] = []
    for c, t in zip(run, tags):
        if t in "BS" or not words:
            words.append(c)
        else:
            words[-1] += c
    return words


def join_unknown(df: DataFrame, words_col: str, model: TagModel, word_chars: str = r"^[\p{L}\p{N}]$") -> DataFrame:
    """``df`` with the runs of two or more single characters (letters or digits, see ``word_chars``) in
    ``words_col`` cut anew. Runs are found per row; each distinct run is decoded once, then joined back
    by its text."""
    single = lambda w: w.rlike(word_chars)
    # fold the array into pieces: (word or run, is a run)
    piece = "struct<text:string,run:boolean>"

    def fold(acc: Column, w: Column) -> Column:
        last = F.element_at(acc, -1)
        joins = (F.size(acc) > 0) & single(w) & F.coalesce(F.get(acc, F.size(acc) - 1)["run"], F.lit(False))
        return F.when(joins, F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.concat(last["text"], w).alias("text"), F.lit(True).alias("run"))))) \
            .otherwise(F.concat(acc, F.array(F.struct(w.alias("text"), single(w).alias("run")))))
    pieces = F.aggregate(F.filter(words_col, lambda w: w.isNotNull()), F.array().cast(f"array<{piece}>"), fold)
    rows = df.withColumn("_fl_row", F.monotonically_increasing_id()).withColumn("_fl_pieces", pieces)
    rows = reliable_checkpoint(rows)  # row numbers must hold
    is_run = lambda p: p["run"] & (F.length(p["text"]) > 1)
    runs = rows.select(explode_values(F.transform(F.filter("_fl_pieces", is_run), lambda p: p["text"])).alias("_fl_run")).filter(F.col("_fl_run").isNotNull()).distinct()

    def decode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield f.assign(_fl_cut=[cut_by_tags(r, best_tags(r, model)) for r in f["_fl_run"]])
    cut = runs.mapInPandas(decode, "_fl_run string, _fl_cut array<string>")
    places = rows.select("_fl_row", F.posexplode("_fl_pieces").alias("_fl_at", "_fl_p")).filter(is_run(F.col("_fl_p"))) \
        .select("_fl_row", "_fl_at", F.col("_fl_p.text").alias("_fl_run")).join(cut, "_fl_run")
    per_row = places.groupBy("_fl_row").agg(F.map_from_entries(F.collect_list(F.struct("_fl_at", "_fl_cut"))).alias("_fl_new"))   # one row's own runs
    joined = rows.join(per_row, "_fl_row", "left")
    words = F.flatten(F.transform("_fl_pieces", lambda p, i: F.coalesce(F.col("_fl_new")[i], F.array(p["text"]))))
    return joined.withColumn(words_col, F.when(F.col(words_col).isNotNull(), words)).drop("_fl_row", "_fl_pieces", "_fl_new")
