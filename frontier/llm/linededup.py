r"""Repeated runs of lines, by suffix ranks over line ids.

The corpus is read as sequences of line ids, one sequence for each document. Prefix
doubling gives every position the rank of its suffix among all suffixes, judged by the
first 1, 2, 4, ... lines: the ranks of two neighbouring halves form a pair, distinct pairs
are sorted by range over the cluster, and the place in that order is the next rank. Only
positions whose prefix occurs twice go on to the next step, so unique text leaves at once.

A run of lines is an interval of that order: all suffixes that share its lines. Two ranks
of halves that overlap name a run of any length. A run counts when it has ``min_words``
words or more. Every maximal run is the union of the shortest such runs that begin or end
at its lines, so these are looked up, and in each interval the first place (by id, then
position) stays while the lines of all later places are deleted. As every line of a run
has a word, ``min_words`` also bounds the lines of a shortest run, and with it the number
of doubling steps.

DataFrame operations only. Hot lines are counted with partial aggregation before any
shuffle, and joins on them are plain inner joins, which are split when they are skewed.

Lines are the parts between ``\n``; words are runs without space and 0x09-0x0D. Lines
without a word take no part and are never deleted on their own, but a text that keeps
lines without a word only becomes empty. Line ids are 96 bits of hash.

Defined results: null and empty texts stay as they are; rows with a null id stay as they
are; equal rows (id and text) count as one document and get the same result, rows that
share an id but not the text are documents of their own; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from frontier.session import cut_lineage

MIN_WORDS = 50
_WORD = r"[^\x20\x09-\x0D]+"


def _ranked(keys: DataFrame, columns: list[str], name: str) -> DataFrame:
    """The distinct ``columns`` that occur at least twice, with their place in sorted order.

    The sort is by range, so the id of partition and row rises with it; the result is
    written before it is used, and rows are distinct, so a task run again gives the same."""
    twice = keys.groupBy(*columns).agg(F.count("*").alias("__n")).where("__n > 1").select(*columns)
    return cut_lineage(twice.orderBy(*columns).withColumn(name, F.monotonically_increasing_id()))


def _positions(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, th, i, k, w, r): the lines that occur at least twice, by document and place;
    ``i`` counts all lines, ``k`` those with a word, ``w`` words, ``r`` is the line id."""
    lines = (docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
             .select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"), F.split(text_col, "\n").alias("lines"))
             .select("id", "th", F.expr(f"filter(transform(lines, (x, i) -> struct(i AS i, x AS x, regexp_count(x, r'{_WORD}') AS w)), s -> s.w > 0)").alias("lines"))
             .select("id", "th", F.posexplode("lines").alias("k", "s"))
             .select("id", "th", "k", "s.i", "s.w", F.xxhash64("s.x").alias("h1"), F.hash("s.x").alias("h2")))
    lines = cut_lineage(lines)   # hashes and counts of lines: the texts are read once
    ids = _ranked(lines, ["h1", "h2"], "r")
    return cut_lineage(lines.join(ids, ["h1", "h2"]).select("id", "th", "k", "i", "w", "r").dropDuplicates(["id", "th", "k"]))


def _shortest_runs(positions: DataFrame, min_words: int) -> DataFrame:
    """(id, th, k, len): for every position the shortest runs of at least ``min_words``
    words that begin or end there, among neighbouring positions."""
    at = Window.partitionBy("id", "th").orderBy("k")
    ahead = at.rowsBetween(0, min_words - 1)
    back = at.rowsBetween(-(min_words - 1), 0)
    near = positions.select("id", "th", "k", F.collect_list(F.struct("k", "w")).over(ahead).alias("f"),
                            F.reverse(F.collect_list(F.struct("k", "w")).over(back)).alias("b"))
    # lines until the words suffice; 0 where a gap or the end of the text comes first
    count = lambda side, step: f"""aggregate({side}, named_struct('n', 0, 'w', 0, 'ok', true),
        (a, x) -> IF(a.ok AND a.w < {min_words} AND x.k = k + ({step}) * a.n, named_struct('n', a.n + 1, 'w', a.w + x.w, 'ok', true),
                     named_struct('n', a.n, 'w', a.w, 'ok', false)),
        a -> IF(a.w >= {min_words}, a.n, 0))"""  # noqa: E731
    sized = near.select("id", "th", "k", F.expr(count("f", 1)).alias("nf"), F.expr(count("b", -1)).alias("nb"))
    return (sized.select("id", "th", F.explode(F.array(F.struct(F.col("k"), F.col("nf").alias("len")),
                                                       F.struct((F.col("k") - F.col("nb") + 1).alias("k"), F.col("nb").alias("len")))).alias("s"))
            .select("id", "th", "s.k", "s.len").where("len > 0").distinct())


def deleted_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(id, th, k, i, first_id, first_k): the lines of later copies, ``th`` being the hash of
    the text; with a place of the earlier copy (that of the line's first repeated run)."""
    positions = _positions(docs, id_col, text_col)
    runs = cut_lineage(_shortest_runs(positions, min_words))
    longest = runs.agg(F.max("len")).first()[0] or 0
    at = Window.partitionBy("id", "th").orderBy("k")
    level = positions.select("id", "th", "k", "r")
    named = None
    step = 1
    while step <= longest:
        # runs of step to 2 * step - 1 lines: two ranks of this level, the second where the run's last ``step`` lines begin
        own = runs.where(F.col("len").between(step, 2 * step - 1)).withColumn("k2", F.col("k") + F.col("len") - step)
        one = level.select("id", "th", "k", F.col("r").alias("ra"))
        two = level.select("id", "th", F.col("k").alias("k2"), F.col("r").alias("rb"))
        found = own.join(one, ["id", "th", "k"]).join(two, ["id", "th", "k2"]).select("id", "th", "k", "len", "ra", "rb")
        named = found if named is None else named.unionByName(found)
        if 2 * step <= longest:
            pairs = (level.select("id", "th", "k", "r", F.lead("r", step).over(at).alias("r2"), F.lead("k", step).over(at).alias("k2"))
                     .where(F.col("k2") == F.col("k") + step).select("id", "th", "k", F.col("r").alias("r1"), "r2"))
            names = _ranked(pairs, ["r1", "r2"], "r")
            level = cut_lineage(pairs.join(names, ["r1", "r2"]).select("id", "th", "k", "r"))
        step *= 2
    if named is None:
        named = runs.select("id", "th", "k", "len", F.lit(0).cast("bigint").alias("ra"), F.lit(0).cast("bigint").alias("rb")).where("false")
    named = cut_lineage(named)
    place = F.struct("id", "th", "k")
    first = named.groupBy("len", "ra", "rb").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    later = named.join(first, ["len", "ra", "rb"]).where(place > F.col("first"))
    lines = (later.select("id", "th", "first", F.col("k").alias("begin"), F.explode(F.sequence("k", F.col("k") + F.col("len") - 1)).alias("k"))
             .groupBy("id", "th", "k").agg(F.min(F.struct("begin", "first")).alias("m")))
    return (lines.join(positions.select("id", "th", "k", "i"), ["id", "th", "k"])
            .select("id", "th", "k", "i", F.col("m.first.id").alias("first_id"), (F.col("m.first.k") + F.col("k") - F.col("m.begin")).alias("first_k")))


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Deleted runs: id, first and last line number, lines, and the id of an earlier copy of the first line."""
    at = Window.partitionBy("id", "th").orderBy("k")
    lines = deleted_lines(docs, id_col, text_col, min_words).withColumn("run", F.col("k") - F.row_number().over(at))
    return (lines.groupBy("id", "th", "run").agg(F.min("i").alias("first_line"), F.max("i").alias("last_line"), F.count("*").alias("n_lines"),
                                                  F.min(F.struct("k", "first_id")).alias("m"))
            .select(F.col("id").alias(id_col), "first_line", "last_line", "n_lines", F.col("m.first_id").alias("earlier_id")))


def _cleaned(docs: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """``docs`` with ``__llm_n`` (deleted lines) and ``__llm_text`` (what is left)."""
    gone = (deleted_lines(docs, id_col, text_col, min_words).groupBy(F.col("id").alias("__llm_id"), F.col("th").alias("__llm_th"))
            .agg(F.collect_set("i").alias("__llm_gone")))
    joined = docs.join(gone, (docs[id_col] == F.col("__llm_id")) & (F.xxhash64(docs[text_col]) == F.col("__llm_th")), "left")
    # places that stay by a set difference; the lines are split once, as the lambda's variable
    left = F.transform(F.array(F.split(F.col(text_col), "\n")), lambda lines: F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__llm_gone")), lambda i: lines[i]))[0]
    left = F.when(F.exists(left, lambda x: x.rlike(_WORD)), F.concat_ws("\n", left)).otherwise("")
    return joined.select("*", F.coalesce(F.size(F.col("__llm_gone")), F.lit(0)).alias("__llm_size")).select(
        *[docs[c] for c in docs.columns], F.greatest("__llm_size", F.lit(0)).cast("bigint").alias("__llm_n"),
        F.when(F.col("__llm_gone").isNull(), F.col(text_col)).otherwise(left).alias("__llm_text"))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Per row: ``id_col``, ``n_lines`` (0 for null), ``n_removed``, and the ``text`` that is left."""
    rows = _cleaned(docs.select(id_col, text_col), id_col, text_col, min_words)
    lines = F.when(F.col(text_col).isNull(), 0).otherwise(F.size(F.split(text_col, "\n"))).cast("bigint")
    return rows.select(id_col, lines.alias("n_lines"), F.col("__llm_n").alias("n_removed"), F.col("__llm_text").alias("text"))


def drop_repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size_col: str | None = None,
                       min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without the lines of later copies; documents of which nothing is left go.
    ``size_col`` names a column to hold the characters of the new text."""
    rows = _cleaned(docs, id_col, text_col, min_words).where("NOT (__llm_n > 0 AND __llm_text = '')")
    new = {text_col: F.col("__llm_text")}
    if size_col is not None:
        kind = docs.schema[size_col].dataType
        new[size_col] = F.when(F.col("__llm_n") > 0, F.char_length("__llm_text").cast(kind)).otherwise(F.col(size_col))
    return rows.select(*[new.get(c, F.col(c)).alias(c) for c in docs.columns])


#: DuckDB SQL of the registered query, from the definition: equal lines of two places lie on
#: a diagonal, and every gapless stretch of it with 50 words or more is a repeated run.
SQL = r"""
WITH l AS (SELECT doc_id, i, lines[i + 1] AS line, len(regexp_extract_all(lines[i + 1], '[^\x20\x09-\x0D]+')) AS w
           FROM (SELECT doc_id, lines, unnest(range(0, len(lines))) AS i
                 FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL))),
k AS (SELECT doc_id, i, line, w, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM l WHERE w > 0),
p AS (SELECT a.doc_id AS da, a.k AS ka, b.doc_id AS db, b.k AS kb, a.w FROM k a JOIN k b ON a.line = b.line
      WHERE b.doc_id < a.doc_id OR (b.doc_id = a.doc_id AND b.k < a.k)),
g AS (SELECT da, ka, db, kb, w, ka - row_number() OVER (PARTITION BY da, db, ka - kb ORDER BY ka) AS g FROM p),
t AS (SELECT da, ka, sum(w) OVER (PARTITION BY da, db, ka - kb, g) AS words FROM g),
d AS (SELECT DISTINCT da AS doc_id, ka AS k FROM t WHERE words >= 50),
m AS (SELECT l.*, d.k IS NOT NULL AS gone FROM l LEFT JOIN k USING (doc_id, i) LEFT JOIN d ON d.doc_id = l.doc_id AND d.k = k.k),
o AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed, string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone) AS kept,
             coalesce(bool_or(w > 0) FILTER (WHERE NOT gone), false) AS any_word FROM m GROUP BY doc_id)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
       CASE WHEN coalesce(n_removed, 0) = 0 THEN text WHEN any_word THEN kept ELSE '' END AS text
FROM documents LEFT JOIN o USING (doc_id)
"""
