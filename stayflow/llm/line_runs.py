"""Repeated runs of lines: suffixes of line-id sequences ranked by prefix doubling."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.llm.rows import Work
from stayflow.operators.keys import assign_keys

DOC = ["key", "tie"]


@dataclass(frozen=True)
class Settings:
    """``min_lines``: lines of a run from which its later copies go, a power of two.
    ``min_chars``: characters from which a line alone counts as a run."""

    min_lines: int = 2
    min_chars: int = 100


def suffix_blocks(df: DataFrame, key: str, text: str, settings: Settings, work: Work) -> list[DataFrame]:
    """Per level k, the places (key, tie, line, rank, later) of blocks of 2**k lines that occur
    more than once; a block lies within one document.

    Prefix doubling: level 0 ranks the distinct lines, level k+1 ranks the pairs of ranks of
    two adjacent blocks of level k, in order, so equal ranks are the suffixes with a common
    prefix of 2**k lines: an interval of the suffix array whose common prefixes are at
    least that long. A suffix whose block nobody shares has its final place and leaves; most
    lines do so at once. Only distinct blocks are sorted, with their number of places summed up
    first, so a line that fills a third of the rows is one row there; its places are joined
    back under Spark's skew handling. Doubling ends when no block is repeated, after the
    logarithm of the longest repeated run. ``later`` is false for the first place of a
    block, by key, then a hash of the text, then line.
    """
    lines = df.where(F.col(key).isNotNull()).select(
        F.col(key).alias("key"), F.xxhash64(text).alias("tie"), F.posexplode(F.split(text, "\n")).alias("line", "words")
    )
    # Two hashes of 64 bits with different seeds stand for a line.
    named = lines.select(
        *DOC,
        "line",
        F.xxhash64("words").alias("a"),
        F.xxhash64(F.lit(7), "words").alias("b"),
        (F.char_length("words") >= settings.min_chars).alias("long"),
    )
    named = work.store(named.dropDuplicates([*DOC, "line"]), "lines")
    level, levels, width = _ranked(named, ["a", "b"], ["long"], work), [], 1
    while not level.isEmpty():
        levels.append(level)
        after = level.select(*DOC, (F.col("line") - width).alias("line"), F.col("rank").alias("b"))
        pairs = level.select(*DOC, "line", F.col("rank").alias("a")).join(after, [*DOC, "line"])
        level = _ranked(pairs, ["a", "b"], [], work)
        width *= 2
    return levels


def _ranked(places: DataFrame, name: list[str], extra: list[str], work: Work) -> DataFrame:
    """The places whose name is shared, with its rank among the shared names and whether an
    earlier place has the name."""
    place = F.struct("key", "tie", "line")
    shared = places.groupBy(*name).agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).where("n > 1")
    ranks = assign_keys(shared.select(*name, "first"), [F.col(c) for c in name], "rank", 0, work.path("ranks"))
    later = ~place.eqNullSafe(F.col("first"))
    met = places.join(ranks, name)
    return work.store(met.select(*DOC, "line", "rank", later.alias("later"), *extra), "level")


def repeated_lines(
    df: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """(key, tie, removed, longest) of the documents with lines to delete.

    ``removed`` holds, in order, the numbers (from 0) of the lines that lie in a later copy of a run of
    ``min_lines`` lines or of one long line. A run of more lines repeated earlier is
    covered by its blocks of that size, each of which is then repeated earlier too.
    ``longest``: lines of the largest block with an earlier copy.
    """
    work, size = Work(df.sparkSession), settings.min_lines
    if size < 1 or size & (size - 1):
        raise ValueError("min_lines must be a power of two")
    levels = suffix_blocks(df, key, text, settings, work)
    found = None
    for k, level in enumerate(levels):
        own = level.where("later")
        if 1 << k < size:
            own = own.where("long") if k == 0 else own.limit(0)
            count = 1
        else:
            count = size if 1 << k == size else 0
        covered = F.sequence(F.col("line"), F.col("line") + (count - 1)) if count else F.array().cast("array<int>")
        rows = own.select(*DOC, covered.alias("covered"), F.lit(1 << k).alias("block"))
        found = rows if found is None else found.unionByName(rows)
    if found is None:
        kind = df.schema[key].dataType.simpleString()
        ddl = f"key {kind}, tie bigint, removed array<int>, longest int"
        return df.sparkSession.createDataFrame([], ddl)
    per_doc = found.groupBy(*DOC).agg(F.flatten(F.collect_list("covered")).alias("all"), F.max("block").alias("longest"))
    removed = F.sort_array(F.array_distinct("all"))
    return per_doc.select(*DOC, removed.alias("removed"), "longest").where(F.size("removed") > 0)


def remove_repeated_runs(
    df: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """``df`` with later copies of repeated line runs deleted from its texts.

    Adds ``removed_lines`` (numbers of deleted lines, from 0), ``removed_runs`` and
    ``longest_block``. Null texts stay null, a text all of whose lines go becomes empty. Lines
    end at a line feed and must be equal in every character. The order of documents is by key,
    then by a hash of the text; rows equal in both are one document. Rows with null keys stay as
    they are. Each text is shuffled once, to meet its line numbers.
    """
    found = repeated_lines(df, key, text, settings)
    made = ["removed_lines", "removed_runs", "longest_block"]
    kept = [c for c in df.columns if c not in made]
    # The table's own columns are numbered meanwhile, so that they cannot have a name used here.
    number = {c: f"own {i}" for i, c in enumerate(kept)}
    tagged = df.select(
        *[F.col(c).alias(n) for c, n in number.items()], F.col(key).alias("key"), F.xxhash64(text).alias("tie")
    )
    found = found.select(F.struct("*").alias("found"))
    same = (F.col("key") == F.col("found.key")) & (F.col("tie") == F.col("found.tie"))
    met = tagged.join(found, same, "left")
    removed = F.coalesce(F.col("found.removed"), F.array().cast("array<int>"))
    met = met.select(*number.values(), removed.alias("removed_lines"), F.col("found.longest").alias("longest"))
    own_text = number[text]
    left = F.filter(F.split(own_text, "\n"), lambda line, i: ~F.array_contains("removed_lines", i))
    shorter = F.when(F.size("removed_lines") == 0, F.col(own_text)).otherwise(F.array_join(left, "\n"))
    starts = F.filter("removed_lines", lambda x, i: (i == 0) | (F.get("removed_lines", i - 1) != x - 1))
    return met.select(
        *[(shorter if c == text else F.col(n)).alias(c) for c, n in number.items()],
        "removed_lines",
        F.size(starts).alias("removed_runs"),
        F.coalesce("longest", F.lit(0)).alias("longest_block"),
    )


def oracle_sql(settings: Settings = Settings(), levels: int = 13) -> str:
    """The same in SQL for documents of fewer than 2**levels lines, unique by doc_id."""
    parts = [
        "lines as (select doc_id, unnest(range(len(l))) as line, unnest(l) as words from (select doc_id, "
        "string_split(text, chr(10)) as l from documents where text is not null) x)",
        f"n0 as (select doc_id, line, md5(words) as name, length(words) >= {settings.min_chars} as long from lines)",
    ]
    for k in range(levels):
        parts.append(
            f"l{k} as (select *, count(*) over w1 > 1 as shared, row_number() over w2 > 1 as later from n{k} "
            "window w1 as (partition by name), w2 as (partition by name order by doc_id, line))"
        )
        parts.append(
            f"n{k + 1} as (select a.doc_id, a.line, md5(a.name || b.name) as name, false as long from l{k} a "
            f"join l{k} b on a.doc_id = b.doc_id and b.line = a.line + {1 << k} where a.shared and b.shared)"
        )
    base = settings.min_lines.bit_length() - 1
    covers = [f"select doc_id, line + {i} as line from l{base} where later" for i in range(settings.min_lines)]
    covers += ["select doc_id, line from l0 where later and long"] if base else []
    blocks = [f"select doc_id, {1 << k} as block from l{k} where later" for k in range(base, levels)]
    blocks += ["select doc_id, 1 as block from l0 where later and long"] if base else []
    parts += [
        f"gone as ({' union '.join(covers)})",
        f"longest as (select doc_id, max(block) as block from ({' union all '.join(blocks)}) b group by doc_id)",
        "marked as (select l.*, g.line is not null as gone, lag(g.line) over (partition by l.doc_id order by l.line) "
        "as before from lines l left join gone g on g.doc_id = l.doc_id and g.line = l.line)",
        "texts as (select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_removed, "
        "count(*) filter (where gone and before is null) as n_runs, coalesce(string_agg(words, chr(10) order by line) "
        "filter (where not gone), '') as text from marked group by doc_id)",
    ]
    return (
        f"with {', '.join(parts)} select d.doc_id, coalesce(t.n_lines, 0) as n_lines, coalesce(t.n_removed, 0) as "
        "n_removed, coalesce(t.n_runs, 0) as n_runs, coalesce(b.block, 0) as longest_block, "
        "sha256(coalesce(t.text, '')) as text_sha256 "
        "from documents d left join texts t using (doc_id) left join longest b using (doc_id)"
    )
