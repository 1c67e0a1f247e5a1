"""Quality rules: text statistics and a hashed n-gram log-likelihood ratio, in DataFrame functions only.

Every word and pair of neighbouring words of a text falls in one of ``BUCKETS``
hash buckets.  Two multinomials over the buckets are counted with add-one
smoothing: one over the trusted texts, of which a sample of at most ``TRUSTED``
by the hash of their ids is taken, and one over all texts.  A text's score is the
mean over its n-grams of log(trusted share / corpus share); a text whose score
is below a fixed threshold is rejected.  Counting shuffles at most one row a
bucket and task; the scores need one pass over the texts and the buckets' weights.

Word triples that repeat in a text are told by their hashes first; only where two hashes agree are the words
themselves compared.

Edge cases: a null or empty text has no words, all counts 0, fails the base
rules and is not kept; a text of any length is read whole; without trusted texts
the ratio is of a flat one against the corpus's smoothed one, and the threshold still
applies; repeated rows and null ids pass through; null labels are not trusted; an
empty table gives an empty table; columns other than those named are not read, and
:func:`keep` carries them unchanged whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Hash buckets of the n-grams, and the score below which a text is rejected.
BUCKETS, THRESHOLD = 1 << 12, -0.1
#: Trusted texts that the target multinomial is fitted on at most; their ids are broadcast.
TRUSTED = 50_000

#: The white space that parts words.
_SPACE = "\t\n\x0b\x0c\r "
_SYMBOLS = "#*$%&|<>"


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.transform(F.array(value), body)[0]


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def words(text: Column) -> Column:
    """The runs of a text without white space; null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(_without(x, _SPACE)) > 0)
    return _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def _hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def _covered(triples: Column) -> Column:
    """How many words lie in windows that occur twice or more, given what tells windows apart."""
    ordered = F.sort_array(F.transform(triples, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))

    def places(p: Column) -> Column:
        n = F.size(p)
        same = F.filter(
            p,
            lambda x, j: ((j > 0) & (F.get(p, j - 1)["x"] == x["x"])) | ((j < n - 1) & (F.get(p, j + 1)["x"] == x["x"])),
        )
        return F.sort_array(F.transform(same, lambda x: x["i"]))

    def total(at: Column) -> Column:
        steps = F.transform(at, lambda x, j: F.least(F.coalesce(F.get(at, j + 1) - x, F.lit(3)), F.lit(3)))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    return _let(ordered, lambda p: _let(places(p), total))


def _triples(w: Column) -> Column:
    """Each three neighbouring words, of three or more."""
    return F.transform(F.slice(w, 1, F.size(w) - 2), lambda x, i: F.concat_ws(" ", x, F.get(w, i + 1), F.get(w, i + 2)))


def _repeated(hashes: Column, text: Column) -> Column:
    """How many words lie in triples that occur twice or more.  Without two equal hashes there are none; else words decide."""
    return F.when(
        F.size(F.array_distinct(hashes)) < F.size(hashes), _let(words(text), lambda w: _let(_triples(w), _covered))
    ).otherwise(0)


def _windows(hashes: Column, size: int) -> Column:
    """A hash for each run of ``size`` words."""
    last = F.size(hashes) - size + 1
    return F.when(
        last > 0,
        F.transform(F.slice(hashes, 1, last), lambda h, i: F.xxhash64(h, *[F.get(hashes, i + k) for k in range(1, size)])),
    ).otherwise(F.array().cast("array<bigint>"))


def _buckets(hashes: Column, buckets: int) -> Column:
    """The bucket of each word and of each pair of neighbours."""
    return F.transform(F.concat(hashes, _windows(hashes, 2)), lambda h: F.pmod(h, F.lit(buckets)).cast("int"))


def weights(corpus: DataFrame, text_col: str, trusted: Column, buckets: int = BUCKETS) -> DataFrame:
    """One row: ``weights``, the log ratio of each bucket, in order."""
    spark = corpus.sparkSession
    grams = corpus.select(
        F.coalesce(trusted, F.lit(False)).cast("int").alias("t"),
        F.explode(_let(_hashes(F.col(f"`{text_col}`")), lambda h: _buckets(h, buckets))).alias("bucket"),
    )
    counted = grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("t").alias("t"))
    filled = (
        spark.range(buckets)
        .select(F.col("id").cast("int").alias("bucket"))
        .join(F.broadcast(counted), "bucket", "left")  # at most a row a bucket
        .select("bucket", (F.coalesce("n", F.lit(0)) + 1).alias("n"), (F.coalesce("t", F.lit(0)) + 1).alias("t"))
    )
    rows = filled.agg(F.sort_array(F.collect_list(F.struct("bucket", "n", "t"))).alias("rows"), F.sum("n").alias("all_n"), F.sum("t").alias("all_t"))
    return rows.select(
        F.transform(
            "rows", lambda r: F.log(r["t"].cast("double") / F.col("all_t")) - F.log(r["n"].cast("double") / F.col("all_n"))
        ).alias("weights")
    )


def sample(trusted: DataFrame, most: int) -> DataFrame:
    """``trusted_id``: all distinct ids of ``trusted``, or those ``most`` whose hashes are the smallest.

    A histogram of the hashes' upper 16 bits tells first which can be among them, so that no more than ``most`` and
    a 65,536th of all ids meet in one place.
    """
    ids = trusted.select(F.col("id").alias("trusted_id")).filter("trusted_id IS NOT NULL").distinct().withColumn("hash", F.xxhash64("trusted_id"))
    top = F.shiftright("hash", 48)
    upto = Window.orderBy("top").rowsBetween(Window.unboundedPreceding, 0)
    counted = ids.groupBy(top.alias("top")).agg(F.count(F.lit(1)).alias("n")).withColumn("upto", F.sum("n").over(upto))  # 65,536 rows at most
    last = counted.filter(F.col("upto") >= most).agg(F.min("top").alias("last")).first()["last"]
    near = ids if last is None else ids.filter(top <= last)
    return near.orderBy("hash", "trusted_id").limit(most).select("trusted_id")


def judge(
    df: DataFrame,
    trusted: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    buckets: int = BUCKETS,
    most_trusted: int = TRUSTED,
) -> DataFrame:
    """All columns of ``df`` and a struct ``judged`` of the counts, the score and the verdict; a column of that name gives way.

    ``trusted`` holds the ids, column ``id``, of the trusted texts.
    """
    ids = sample(trusted, most_trusted)
    marked = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).join(
        F.broadcast(ids), F.col("id") == F.col("trusted_id"), "left"
    )
    # BUCKETS numbers, whatever the input, become a constant of the plan
    found = weights(marked, "text", F.col("trusted_id").isNotNull(), buckets).first()["weights"]
    table = F.split(F.lit(",".join(map(repr, found))), ",").cast("array<double>")
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))

    def measured(h: Column, w: Column) -> Column:
        grams = F.transform(_buckets(h, buckets), lambda b: F.get(w, b))
        return F.struct(
            F.size(h).cast("long").alias("n_words"),
            F.length(_without(text, _SPACE)).cast("long").alias("word_chars"),
            (F.length(text) - F.length(_without(text, _SYMBOLS))).cast("long").alias("n_symbols"),
            _dup_lines(text).cast("long").alias("n_dup_lines"),
            _let(_windows(h, 3), lambda t: _repeated(t, text)).cast("long").alias("n_repeat_words"),
            F.when(
                F.size(h) > 0, F.aggregate(grams, F.lit(0.0), lambda a, x: a + x) / (2 * F.size(h) - 1)
            ).alias("score"),
        )

    counts = _let(_hashes(F.col(f"`{text_col}`")), lambda h: _let(table, lambda w: measured(h, w)))
    failed = lambda c: (c["n_words"] < 50) | (100 * c["n_repeat_words"] > 50 * c["n_words"])
    return df.withColumn(
        "judged",
        _let(
            counts,
            lambda c: F.struct(
                *[c[n].alias(n) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score")],
                failed(c).alias("base_failed"),
                (~failed(c) & F.coalesce(F.round(c["score"], 9) >= threshold, F.lit(False))).alias("kept"),
            ),
        ),
    )


def keep(df: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df``, as they are, whose texts the rules keep."""
    whole = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    return judge(whole, trusted, "id", "text").filter("judged.kept").select("row.*")


def digest(df: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text's id, counts, base verdict, verdict and score."""
    return judge(df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")), trusted, "doc_id", "text").select(
        "doc_id", "judged.n_words", "judged.word_chars", "judged.n_symbols", "judged.n_dup_lines", "judged.n_repeat_words",
        "judged.base_failed", "judged.kept", F.round("judged.score", 6).alias("score"),
    )
