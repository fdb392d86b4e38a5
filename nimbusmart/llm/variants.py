"""Spelling variants: words one edit apart, found by a frontier in a relational trie.

``word_counts`` counts the words of all texts. ``near_words`` holds them in two
tries, of the words and of the reversed words. A node is a prefix, an edge (side,
node, letter) a row of a distributed table; nothing is a structure of one task.
States (word, position, node, edits) are joined with the edges level by level: a
state without edits may follow any edge (another letter put in for its own), leave
a letter of its own out, or follow its own; a state with one edit follows its own
letters only. A state with one edit at the end of a word is a neighbour. A letter
put in is a letter left out seen from the other word, so it is not walked.

A word starts at the middle: the first half is walked as it is, which is the node
of that prefix, and edits in it are found in the other trie, where they are in the
second half. An edge knows by a hash which rests of words lie behind it (64
bits); a state whose rest isn't among them goes no further. That spares work and
decides nothing.

Scale: a node has at most as many edges as there are letters (90), so a node
that a third of all words share multiplies its states by 90 at most; it is dealt
out by the skew join, since edges and states are both shuffled. Every level reads
only its own edges and is written to the shared folder. The number of levels is
half the longest word. Words of more than ``LONG`` code points, which are rare and
would ask for a level a letter, are compared by fingerprints of what stands
before and behind each letter instead: as many rows as they have letters.

Defined cases: a null text has no words; a null id counts as an empty one in the
checksum; repeated rows count again. Other columns take no part.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nimbusmart.llm.tables import materialise
from nimbusmart.session import scratch_path

MIN_LETTERS, MIN_COUNT, EVERY = 5, 3, 97
LONG = 64
_RUN = re.compile("[A-Za-zÀ-ÿ]{%d,}" % MIN_LETTERS)
_HELD = 200_000  # distinct words a task counts before it hands them on
_MASK = 64


def _counted(every: int):
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def out(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                start = zlib.crc32(b"%s:" % (b"" if doc_id is None else str(doc_id).encode()))
                for raw, n in Counter(_RUN.findall(text.as_py() or "")).items():
                    data = raw.encode().lower()  # of bytes: A-Z only
                    h = zlib.crc32(data, start)
                    word = data.decode()
                    if h % every == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < MIN_LETTERS:
                            continue
                    counts[word] += n
                if len(counts) >= _HELD:
                    yield out(counts)
                    counts = Counter()
        yield out(counts)

    return run, "word string, n long"


def word_counts(docs: DataFrame, least: int = MIN_COUNT, every: int = EVERY) -> DataFrame:
    """(word, n): words of at least five letters, and their occurrences."""
    run, ddl = _counted(every)
    parts = docs.select("doc_id", "text").mapInArrow(run, ddl)
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _sides(words: DataFrame) -> DataFrame:
    """(side, word, m, start): each word in both tries. Every edit lies behind the
    start on exactly one side."""
    m = F.length("word")
    there = words.select(F.lit(0).alias("side"), "word", m.alias("m"), F.floor(m / 2).cast("int").alias("start"))
    back = words.select(F.lit(1), F.reverse("word"), m, F.ceil(m / 2).cast("int"))
    return there.unionAll(back)


def _bit(rest):
    """The bit of a rest of a word in an edge's mask."""
    return F.expr(f"shiftleft(1L, cast(pmod(xxhash64({rest}), {_MASK}) as int))")


def _edges(sides: DataFrame) -> DataFrame:
    """(side, level, node, letter, ends, behind): the edges of both tries. ``ends``:
    a word ends there. ``behind``: bits of what is left of the words that go on."""
    steps = sides.select("side", "word", F.explode(F.sequence("start", F.col("m") - 1)).alias("level"))
    rows = steps.select(
        "side",
        "level",
        F.expr("left(word, level)").alias("node"),
        F.expr("substr(word, level + 1, 1)").alias("letter"),
        F.expr("length(word) = level + 1").alias("last"),
        _bit("substr(word, level + 2)").alias("bit"),
    )
    return rows.groupBy("side", "level", "node", "letter").agg(F.max("last").alias("ends"), F.bit_or("bit").alias("behind"))


def _step(frontier: DataFrame, edges: DataFrame) -> DataFrame:
    """(side, word, near, pos, done): the states with one edit that come from a
    level's states (side, word, near, node, own, next, m) and edges. ``near`` is
    what the word becomes by the edit, null while there is none."""
    met = frontier.join(edges, ["side", "node"])
    walks = F.expr("near is not null and letter = own")
    free = F.col("near").isNull()
    swaps = free & F.expr("letter <> own")
    skips = free & F.expr("letter = next and next <> own")
    drops = free & F.expr("ends and letter = own and m = level + 2")  # the last letter left out
    one = lambda near: F.struct(F.expr(near).alias("near"), F.expr("level + 1").alias("pos"))
    made = met.where(walks | swaps | skips | drops).select(
        "side",
        "word",
        "ends",
        "behind",
        F.explode(
            F.filter(
                F.array(
                    F.when(walks, one("near")),
                    F.when(swaps, one("concat(node, letter, substr(word, level + 2))")),
                    F.when(skips, one("concat(node, substr(word, level + 2))")),
                    F.when(drops, one("left(word, level + 1)")),
                ),
                lambda s: s.isNotNull(),
            )
        ).alias("s"),
    )
    state = made.select("side", "word", "s.near", "s.pos", "ends", "behind")
    state = state.withColumn("done", F.expr("length(near) = pos"))
    on = F.col("behind").bitwiseAND(_bit("substr(near, pos + 1)")) != 0
    return state.where((F.col("done") & F.col("ends")) | (~F.col("done") & on)).select("side", "word", "near", "pos", "done")


def _trie_neighbours(words: DataFrame) -> DataFrame | None:
    """(word, near) in one direction at least, with repeats; words that aren't long."""
    sides = materialise(_sides(words), "variant-sides")
    last = sides.agg(F.max("m")).first()[0]
    if last is None:
        return None
    edges = _edges(sides)
    path = _written_by_level(edges, "variant-edges")
    found, held = [], None
    for level in range(MIN_LETTERS // 2, last):
        here = path.where(F.col("level") == level)
        states = sides.where((F.col("start") <= level) & (F.col("m") > level))
        states = states.select("side", "word", F.lit(None).cast("string").alias("near"))
        if held is not None:
            states = states.unionAll(held.where(~F.col("done")).select("side", "word", "near"))
        own = F.coalesce("near", "word")
        states = states.select(
            "side",
            "word",
            "near",
            F.substring(own, 1, level).alias("node"),
            F.substring(own, level + 1, 1).alias("own"),
            F.expr(f"substr(word, {level + 2}, 1)").alias("next"),
            F.length("word").alias("m"),
        )
        held = materialise(_step(states, here), "variant-states")
        found.append(held.where("done"))
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    turned = lambda c: F.when(F.col("side") == 1, F.reverse(c)).otherwise(F.col(c)).alias(c)
    return out.select(turned("word"), turned("near"))


def _written_by_level(df: DataFrame, name: str) -> DataFrame:
    """Written in one folder a level, so that a level reads its own rows only."""
    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy("level").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _around():
    """For long words: (key, word, kind, size) at every place. The key is what
    stands before and behind it; kind 0 leaves the letter there out, kind 1 none."""
    schema = pa.schema([("key", pa.binary()), ("word", pa.string()), ("kind", pa.int32()), ("size", pa.int64())])

    def prints(data: list[bytes]) -> list[bytes]:
        h, out = xxhash.xxh3_128(), []
        out.append(h.digest())
        for letter in data:
            h.update(letter)
            out.append(h.digest())
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for word in batch.column(0).to_pylist():
                letters = [c.encode() for c in word]
                n = len(letters)
                before, behind = prints(letters), prints(letters[::-1])
                gaps = [before[i] + behind[n - 1 - i] for i in range(n)]
                cuts = [before[i] + behind[n - i] for i in range(n + 1)]
                name = xxhash.xxh3_128_hexdigest(word.encode())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gaps + cuts, pa.binary()), pa.array([name] * (2 * n + 1)), pa.array([0] * n + [1] * (n + 1), pa.int32()), pa.array([n - 1] * n + [n] * (n + 1), pa.int64())],
                    schema=schema,
                )

    return run, "key binary, word string, kind int, size long"


def _long_neighbours(words: DataFrame) -> DataFrame:
    """(word, near) among words of at least ``LONG`` code points. Words with one
    gap in common differ in one letter: at most 90 share a key."""
    run, ddl = _around()
    rows = materialise(words.select("word").mapInArrow(run, ddl), "variant-long")
    gaps = rows.where("kind = 0")
    other = rows.select("key", "size", F.col("word").alias("near"))
    links = gaps.join(other, ["key", "size"]).where("word <> near").select("word", "near").distinct()
    names = materialise(words.select(F.col("word").alias("text"), "word").mapInArrow(*_names()), "variant-names")
    links = links.join(names, "word").select(F.col("text").alias("word"), "near")
    return links.join(names.toDF("full", "near"), "near").select("word", F.col("full").alias("near"))


def _names():
    schema = pa.schema([("text", pa.string()), ("word", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array([xxhash.xxh3_128_hexdigest(t.encode()) for t in texts], pa.string())], schema=schema)

    return run, "text string, word string"


def near_words(words: DataFrame) -> DataFrame:
    """(word, near): all pairs of ``words`` (word) that are one edit apart, both ways."""
    short = _trie_neighbours(words.where(F.length("word") <= LONG))
    # A word of LONG letters stands on both sides, next to its longer neighbours.
    long = words.where(F.length("word") >= LONG)
    found = short
    if not long.where(F.length("word") > LONG).isEmpty():
        more = _long_neighbours(long)
        found = more if found is None else found.unionAll(more)
    if found is None:
        return words.select("word", F.col("word").alias("near")).limit(0)
    return found.unionAll(found.select(F.col("near").alias("word"), F.col("word").alias("near"))).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): forms (word, form) followed to the last, by doubling."""
    roots = materialise(forms.toDF("word", "root"), "variant-roots")
    while True:
        ahead = roots.toDF("root", "further")
        roots = roots.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        roots = materialise(roots, "variant-roots")
        if roots.where("moved").isEmpty():
            return roots.select("word", "root")
        roots = roots.select("word", "root")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n for every word of ``docs``: its form
    is the commonest word one edit away, if that is at least twice as common."""
    words = materialise(word_counts(docs), "variant-words")
    links = near_words(words.select("word"))
    counted = links.join(words.toDF("near", "near_n"), "near")
    best = F.min(F.struct((-F.col("near_n")).alias("rank"), F.col("near")))
    groups = counted.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    rows = words.join(groups, "word", "left")
    formed = -F.col("best.rank") >= 2 * F.col("n")
    rows = rows.select(
        "word",
        F.when(formed, F.col("best.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(formed, -F.col("best.rank")).alias("form_n"),
    )
    rows = materialise(rows, "variant-forms")
    roots = _roots(rows.where("form is not null").select("word", "form"))
    out = rows.join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
