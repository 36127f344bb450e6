"""Divergence audit of sources: how the word shares of a source differ from those of its language.

Terms are runs of ASCII letters and non-ASCII characters with A-Z lower-cased. A
language keeps the terms that stand in at least ``MIN_DOCUMENTS`` of its documents.
Every (language, source) group and every language gives a kept term the share
``p = 1 + floor(SCALE * (count + 5) / (N + 5 * V))``, with ``N`` its occurrences of
kept terms and ``V`` the number of kept terms. Part ``pair`` sums ``|p - q|`` over
all kept terms for each two sources of a language; part ``term`` ranks the terms
that a group uses more than its language does.

Strings come late. A first scan counts documents by digests of fixed width, which
alone are shuffled. A second one counts the terms whose digests can be kept, in
each task, and writes the digests and counts; each string is written once a
language and task, or again when the task has met too many others. The least and the greatest string of a digest tell whether several
terms share it; those, if any, are counted by string in a scan of their own. The
text of a term joins the result for the ranks that are returned. Up to
``MAX_SHIPPED`` digests that can be kept go to the tasks; if there are more, the
second scan writes all terms and Spark joins them.

A term's share is constant in all groups that do not have it, so only the counts
that are not zero are rows; a task puts those of a block of terms in a matrix
and adds up all pairs of sources, which then are one row per task and pair.

Null text, language and source count as ''. Rows with equal ids are documents of
their own. A text is scanned in slices of about ``SLICE`` bytes that end between
terms; a term of any length is one term. An empty table gives no rows; other
columns do not matter.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetmatch.llm.common import pick, pieces, stored
from fleetmatch.llm.tokens import Recent

MIN_DOCUMENTS = 30
SCALE = 1_000_000_000
SMOOTH = 5
TOP_TERMS = 50
DIGEST_BITS = 64
SLICE = 1 << 20
TABLE_TERMS = 1 << 19      # terms a task counts before it writes them
TERM_NUMBERS = 16          # occurrences, kept as numbers, that take no more memory than a term
MAX_SHIPPED = 1 << 19      # digests that a task is given
BLOCK_CELLS = 1 << 18      # of a matrix of terms and sources
PAIR_CELLS = 1 << 21       # sums of pairs a task keeps

# Lower-case letters and other characters; what separates terms becomes a space.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))
_between = re.compile(rb"[^A-Za-z\x80-\xff]").search


def _slices(text: bytes, most: int = SLICE) -> Iterator[bytes]:
    begin = 0
    while len(text) - begin > most:
        place = _between(text, begin + most)
        if place is None:
            break
        yield text[begin:place.start()]
        begin = place.start()
    yield text[begin:] if begin else text


def terms_of(text: bytes) -> Iterable[bytes]:
    """The terms in order, with repetitions; bytes are lower-cased in ASCII only."""
    if len(text) <= SLICE:
        return text.translate(_LETTERS).split()
    return chain.from_iterable(part.translate(_LETTERS).split() for part in _slices(text))


def _digests(words: list[bytes], bits: int) -> np.ndarray:
    found = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    return (found >> np.uint64(64 - bits)).astype(np.int64)


class _Numbers(Recent):
    """The place of a term's digest among those given, or -1; the terms seen last are remembered.

    ``told`` gets the terms with a place when they are looked up.
    """

    def __init__(self, digests: np.ndarray, bits: int):
        places = {digest: place for place, digest in enumerate(digests.astype(np.uint64).tolist())}
        self.digests, self.told, shift = digests, {}, 64 - bits

        def place_of(word: bytes) -> int:
            place = places.get(xxhash.xxh3_64_intdigest(word) >> shift, -1)
            if place >= 0:
                self.told[word] = place
            return place

        super().__init__(place_of)


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _repeated(value: str, number: int) -> pa.Array:
    return pa.array([value], pa.string()).take(pa.array(np.zeros(number, np.int32)))


def _counting(docs: DataFrame, schema: str, add, rows, each: int = 1) -> DataFrame:
    """What ``rows(tables)`` gives for tables that ``add(tables, lang, source, text)`` fills.

    ``add`` returns by how many terms, times ``each``, the tables have grown; they are emptied in between.
    """
    most = TABLE_TERMS * each

    def run(batches):
        tables, size = {}, 0
        for batch in pieces(batches, "text"):
            for text, lang, source in zip(*(batch.column(i).to_pylist() for i in range(3))):
                size += add(tables, lang, source, text)
                if size >= most:
                    yield from rows(tables)
                    tables, size = {}, 0
        yield from rows(tables)

    return docs.select(F.col("text").cast("binary").alias("text"), "lang", "source").mapInArrow(run, schema)


def document_counts(docs: DataFrame, bits: int) -> DataFrame:
    """``lang``, ``digest``, ``docs``: documents with a term, by task."""
    def add(tables, lang, source, text):
        table = tables.setdefault(lang, Counter())
        before = len(table)
        table.update(set(terms_of(text)))
        return len(table) - before

    def rows(tables):
        for lang, table in tables.items():
            yield _batch(lang=_repeated(lang, len(table)), digest=pa.array(_digests(list(table), bits)),
                         docs=pa.array(list(table.values()), pa.int64()))

    return _counting(docs, "lang string, digest bigint, docs bigint", add, rows)


def term_counts(docs: DataFrame, wanted: Broadcast | None, bits: int) -> DataFrame:
    """``lang``, ``source``, ``digest``, ``n`` by task, as a table; rows with a ``word`` give the digest's string.

    Each string has a row; it may be a row without ``source`` and ``n``.
    """
    schema = "lang string, source string, digest bigint, n bigint, word binary"
    if wanted is None:
        return stored(_counting(docs, schema, *_by_word(bits)), "terms")
    return stored(_counting(docs, schema, *_by_number(wanted, bits), each=TERM_NUMBERS), "terms")


def _by_word(bits: int):
    def add(tables, lang, source, text):
        table = tables.setdefault((lang, source), Counter())
        before = len(table)
        table.update(terms_of(text))
        return len(table) - before

    def rows(tables):
        told = {}
        for (lang, source), table in tables.items():
            if not table:
                continue
            seen, words = told.setdefault(lang, set()), list(table)
            given = [None if word in seen else word for word in words]
            seen.update(words)
            yield _batch(lang=_repeated(lang, len(words)), source=_repeated(source, len(words)),
                         digest=pa.array(_digests(words, bits)), n=pa.array(list(table.values()), pa.int64()),
                         word=pa.array(given, pa.binary()))

    return add, rows


def _by_number(wanted: Broadcast, bits: int):
    """Occurrences are kept as numbers of four bytes, and counted when the tables are emptied."""
    known: dict[str, _Numbers] = {}  # of one task; it stays when the tables are emptied

    def add(tables, lang, source, text):
        if lang not in known:
            known[lang] = _Numbers(wanted.value.get(lang, np.zeros(0, np.int64)), bits)
        told = known[lang].told
        before = len(told)
        found = np.fromiter(map(known[lang].__getitem__, terms_of(text)), np.int32)
        found = found[found >= 0]
        tables.setdefault((lang, source), array("i")).frombytes(found.tobytes())
        return len(found) + TERM_NUMBERS * (len(told) - before)

    def rows(tables):
        for lang, numbers in known.items():
            words, told = list(numbers.told), len(numbers.told)
            digests = numbers.digests[np.fromiter(numbers.told.values(), np.int64, told)]
            numbers.told.clear()
            yield _batch(lang=_repeated(lang, told), source=pa.nulls(told, pa.string()), digest=pa.array(digests),
                         n=pa.nulls(told, pa.int64()), word=pa.array(words, pa.binary()))
        for (lang, source), found in tables.items():
            counts = np.bincount(np.frombuffer(found, np.int32)) if found else np.zeros(0, np.int64)
            some = np.flatnonzero(counts)
            yield _batch(lang=_repeated(lang, len(some)), source=_repeated(source, len(some)),
                         digest=pa.array(known[lang].digests[some]), n=pa.array(counts[some], pa.int64()),
                         word=pa.nulls(len(some), pa.binary()))

    return add, rows


def split_counts(docs: DataFrame, wanted: Broadcast | None, bits: int) -> DataFrame:
    """``lang``, ``source``, ``digest``, ``split`` (the term), ``n`` and ``docs`` of the terms wanted, by task."""
    sets: dict[str, frozenset] = {}

    def add(tables, lang, source, text):
        if wanted is not None and lang not in sets:
            sets[lang] = frozenset(wanted.value.get(lang, np.zeros(0, np.int64)).tolist())
        keep = sets.get(lang)
        counted = Counter(terms_of(text))
        words = list(counted)
        table = tables.setdefault((lang, source), {})
        before = len(table)
        for word, digest in zip(words, _digests(words, bits).tolist()):
            if keep is None or digest in keep:
                n, held, _ = table.get(word, (0, 0, 0))
                table[word] = (n + counted[word], held + 1, digest)
        return len(table) - before

    def rows(tables):
        for (lang, source), table in tables.items():
            n, held, digests = zip(*table.values()) if table else ((), (), ())
            yield _batch(lang=_repeated(lang, len(table)), source=_repeated(source, len(table)),
                         digest=pa.array(digests, pa.int64()), split=pa.array(list(table), pa.binary()),
                         n=pa.array(n, pa.int64()), docs=pa.array(held, pa.int64()))

    return _counting(docs, "lang string, source string, digest bigint, split binary, n bigint, docs bigint", add, rows)


def _shipped(digests: DataFrame) -> Broadcast | None:
    """The digests by language for the tasks, if they are few enough."""
    if digests.count() > MAX_SHIPPED:
        return None
    found = digests.toPandas()
    return digests.sparkSession.sparkContext.broadcast(
        {lang: rows["digest"].to_numpy(np.int64) for lang, rows in found.groupby("lang")})


def kept_counts(docs: DataFrame, min_documents: int, bits: int) -> tuple[DataFrame, DataFrame]:
    """The kept terms' counts, and ``lang``, ``digest``, ``word`` of all terms that can be kept, with repetitions.

    The counts have ``lang``, ``digest``, ``split``, ``source`` and ``n``; ``split`` is the
    term if its digest has several, else empty.
    """
    key = ["lang", "digest"]
    # A term in enough documents has a digest in enough; a digest may have them from several terms.
    possible = stored(document_counts(docs, bits).groupBy(*key).agg(F.sum("docs").alias("docs"))
                      .filter(F.col("docs") >= min_documents).select(*key), "possible-terms")
    wanted = _shipped(possible)
    terms = term_counts(docs, wanted, bits)
    if wanted is None:
        terms = terms.join(possible, key, "left_semi")
    words = terms.filter("word is not null").select(*key, "word")
    shared = stored(words.groupBy(*key).agg(F.min("word").alias("low"), F.max("word").alias("high"))
                    .filter(F.col("low") < F.col("high")).select(*key), "shared-digests")
    alone, apart = terms.filter("n is not null").select(*key, "source", "n"), None
    columns = [*key, "split", "source", "n"]
    if not shared.isEmpty():
        alone = alone.join(shared, key, "left_anti")
        apart = split_counts(docs, _shipped(shared), bits).join(shared, key, "left_semi")
        apart = apart.groupBy(*key, "split", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        enough = apart.groupBy(*key, "split").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= min_documents)
        apart = apart.drop("docs").join(enough, [*key, "split"], "left_semi").select(*columns)
    counts = alone.groupBy(*key, "source").agg(F.sum("n").alias("n")).withColumn("split", F.lit(b"")).select(*columns)
    return stored(counts if apart is None else counts.unionByName(apart), "kept-terms"), words


def _share(count, total, kept):
    """1 + floor(SCALE * (count + SMOOTH) / (total + SMOOTH * kept)), in exact integers."""
    above = (F.col(count) + SMOOTH).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    below = (F.col(total) + SMOOTH * F.col(kept)).cast("decimal(20,0)")
    return F.call_function("div", above, below) + 1


def _pair_batch(lang: str, a: int, values: np.ndarray) -> pa.RecordBatch:
    """The sums of source ``a`` with each later one."""
    number = len(values)
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * number, pa.string()), pa.array(np.full(number, a), pa.int32()),
         pa.array(np.arange(a + 1, a + 1 + number), pa.int32()), pa.array(values, pa.int64())], ["lang", "a", "b", "value"])


class _Block:
    """The shares of some terms of a language in all its sources."""

    def __init__(self, lang: str):
        self.lang, self.absent, self.shares = lang, [], None
        self.filled, self.term = 0, None

    def put(self, term: tuple, number: int, share: int) -> None:
        if self.shares is None:
            self.absent = np.array(self.absent, np.int64)
            self.shares = np.empty((max(1, BLOCK_CELLS // len(self.absent)), len(self.absent)), np.int64)
        if term != self.term:
            self.shares[self.filled] = self.absent
            self.term, self.filled = term, self.filled + 1
        self.shares[self.filled - 1, number] = share

    def is_full(self, term: tuple) -> bool:
        return self.shares is not None and term != self.term and self.filled == len(self.shares)

    def sums(self) -> Iterator[tuple[int, np.ndarray]]:
        """Each source number with its sums with the later ones; the block is empty then."""
        if self.filled:
            rows = self.shares[:self.filled]
            for a in range(rows.shape[1] - 1):
                yield a, np.abs(rows[:, a + 1:] - rows[:, a:a + 1]).sum(0)
        self.filled, self.term = 0, None


def _pair_sums(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """``lang``, ``a``, ``b``, ``value``: sums of |p - q| over the kept terms, for source numbers a < b.

    ``groups`` has ``lang``, ``number`` and ``absent``, the share of a term the group
    does not have; ``shares`` has ``lang``, ``number``, ``digest``, ``split`` and ``p``
    of the terms it has. A language's terms are dealt to buckets by digest, and each
    bucket gets the language's groups first.
    """
    def run(batches):
        kept: dict[str, dict[int, np.ndarray]] = {}
        cells, block, at = 0, None, None

        def flushed(block):
            nonlocal cells
            sources = len(block.absent)
            if sources ** 2 > PAIR_CELLS:  # too many to keep: each block's sums go out
                for a, values in block.sums():
                    yield _pair_batch(block.lang, a, values)
                return
            if block.lang not in kept:
                if cells + sources ** 2 > PAIR_CELLS:
                    yield from emptied()
                cells += sources ** 2
            table = kept.setdefault(block.lang, {})
            for a, values in block.sums():
                table[a] = table[a] + values if a in table else values

        def emptied():
            nonlocal cells
            for lang, table in kept.items():
                for a, values in table.items():
                    yield _pair_batch(lang, a, values)
            kept.clear()
            cells = 0

        for batch in batches:
            for lang, bucket, digest, split, number, share in zip(*(column.to_pylist() for column in batch.columns)):
                if (lang, bucket) != at:
                    if block:
                        yield from flushed(block)
                    block, at = _Block(lang), (lang, bucket)
                if digest is None:
                    block.absent.append(share)
                    continue
                if block.is_full((digest, split)):
                    yield from flushed(block)
                block.put((digest, split), number, share)
        if block:
            yield from flushed(block)
        yield from emptied()

    buckets = int(shares.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = ["lang", "bucket", "digest", "split", "number", "p"]
    heads = groups.select("lang", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket"),
                          F.lit(None).cast("bigint").alias("digest"), F.lit(b"").alias("split"), "number",
                          F.col("absent").alias("p"))
    body = shares.withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(buckets)).cast("int"))
    dealt = heads.select(*columns).unionByName(body.select(*columns)).repartition("lang", "bucket")
    dealt = dealt.sortWithinPartitions("lang", "bucket", F.col("digest").asc_nulls_first(), "split", "number")
    return dealt.mapInArrow(run, "lang string, a int, b int, value bigint").groupBy("lang", "a", "b").agg(
        F.sum("value").alias("value"))


def _ranked(rows: DataFrame, most: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    ranked = rows.withColumn("rank", F.row_number().over(order))
    ranked = ranked if most is None else ranked.filter(F.col("rank") <= most)
    return ranked.select("lang", "source", "part", "item", "value", "rank")


def divergence(df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
               min_documents: int = MIN_DOCUMENTS, top: int = TOP_TERMS, bits: int = DIGEST_BITS) -> DataFrame:
    """``lang``, ``source``, ``part`` (pair or term), ``item``, ``value`` and ``rank``; ``top`` limits the terms reported."""
    rows = pick(df, {"text": text_col, "lang": lang_col, "source": source_col})
    docs = rows.select(*[F.coalesce(name, F.lit("")).alias(name) for name in ("text", "lang", "source")])
    counts, words = kept_counts(docs, min_documents, bits)
    by_lang = counts.groupBy("lang", "digest", "split").agg(F.sum("n").alias("lang_n"))
    langs = by_lang.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = stored(docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left")
                    .join(langs, "lang", "left").fillna(0, ["total", "kept", "lang_total"])
                    .withColumn("number", number), "groups")

    shares = stored(counts.join(groups, ["lang", "source"]).withColumn("p", _share("n", "total", "kept"))
                    .join(by_lang, ["lang", "digest", "split"]).withColumn("q", _share("lang_n", "lang_total", "kept"))
                    .select("lang", "source", "number", "digest", "split", "p", "q"), "shares")
    with_terms = groups.filter("kept > 0").withColumn("none", F.lit(0).cast("bigint"))
    sums = _pair_sums(with_terms.select("lang", "number", _share("none", "total", "kept").alias("absent")), shares)
    one = groups.select("lang", "source", "number")
    other = groups.select("lang", F.col("source").alias("item"), F.col("number").alias("other"))
    pairs = one.join(other, "lang").filter("number <> other").withColumns(
        {"a": F.least("number", "other"), "b": F.greatest("number", "other")}).join(sums, ["lang", "a", "b"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value"))

    # Ties at the last rank all stay until their strings can decide.
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    leading = (shares.withColumn("value", F.col("p") - F.col("q")).filter("value > 0")
               .withColumn("place", F.rank().over(best)).filter(F.col("place") <= top)
               .select("lang", "source", "digest", "split", "value"))
    leading = stored(leading, "leading-terms")
    wanted = leading.filter(F.length("split") == 0).select("lang", "digest").distinct()
    words = words.join(wanted, ["lang", "digest"], "left_semi").distinct().withColumn("split", F.lit(b""))
    named = leading.join(words, ["lang", "digest", "split"], "left").select(
        "lang", "source", F.lit("term").alias("part"), F.coalesce("word", "split").cast("string").alias("item"), "value")
    return _ranked(pairs).unionByName(_ranked(named, top))


ORACLE = r"""
WITH docs AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms, row_number() OVER () AS doc FROM documents),
tokens AS (SELECT lang, source, doc, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term FROM tokens GROUP BY lang, term HAVING count(DISTINCT doc) >= 30),
counts AS (SELECT lang, source, term, count(*) AS n FROM tokens SEMI JOIN kept USING (lang, term) GROUP BY ALL),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
every AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n FROM groups g JOIN kept k ON k.lang = g.lang
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
shares AS (
  SELECT e.lang, e.source, e.term, e.n, 1 + (1000000000::HUGEINT * (e.n + 5))
    // (sum(e.n) OVER (PARTITION BY e.lang, e.source) + 5 * s.v)::HUGEINT AS p FROM every e JOIN sizes s ON s.lang = e.lang),
whole AS (SELECT lang, term, sum(n) AS n FROM every GROUP BY lang, term),
whole_shares AS (
  SELECT w.lang, w.term, 1 + (1000000000::HUGEINT * (w.n + 5))
    // (sum(w.n) OVER (PARTITION BY w.lang) + 5 * s.v)::HUGEINT AS q FROM whole w JOIN sizes s ON s.lang = w.lang),
differences AS (
  SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value FROM shares x
  JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(d.value, 0) AS value FROM groups a
  JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN differences d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
  UNION ALL
  SELECT x.lang, x.source, 'term', x.term, x.p - w.q FROM shares x JOIN whole_shares w ON w.lang = x.lang AND w.term = x.term
  WHERE x.n > 0 AND x.p > w.q)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
WHERE part = 'pair' OR rank <= 50
"""
