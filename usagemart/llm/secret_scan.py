"""Secrets: fixed patterns, and strings that pass a battery of randomness tests. DataFrame operations only.

Long strings over the letters of an encoding are candidates. Their encoding is inferred (hex, base 32,
base 36, base 64, letters of one or both cases); plain numbers have none. A candidate that fits none as a whole is
split at ``-_+/``, and its long pieces are tested, or without such pieces all of it but the separators. Four tests ask
whether the characters may have been drawn evenly: chi-squared of their counts, chi-squared of coarse classes
(digits, vowels and consonants, by case), which names of words fail at once, runs of the alphabet's halves, and serial
correlation; the least p-value counts four times.

Within each encoding and length class a limit on the p-value decides. Even strings have even p-values, so the distinct
strings above one half tell how many even ones there are, and the limit is the least at which no more than
``ORDINARY_SHARE`` of the strings kept as secrets are likely to be ordinary (false discoveries). Whatever the mixture, it is
no higher than ``LOST_SHARE``, so that of truly random strings nominally no larger share is lost.

Defined cases: null or empty text holds nothing; repeated rows each get the same result; candidates
that overlap a pattern's span add none; an empty table gives an empty result. Only ``doc_id`` and
``text`` are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from usagemart.llm.rows import by_row, row_key, stored, texts

# The patterns of the contract, in its order, with the group and least length that count.
PATTERNS = {
    "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),
}
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}+={0,2}"
# Alphabets in the order of their codes.
ENCODINGS = {
    "hex": (r"^(?=.*[0-9])(?=.*[a-fA-F])([0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef"),
    "base32": (r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    "base36": (r"^(?=.*[0-9])(?=.*[A-Za-z])([0-9a-z]+|[0-9A-Z]+)$", "0123456789abcdefghijklmnopqrstuvwxyz"),
    "base64": (r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/_-]+$",
               "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    "letters": (r"^(?=.*[a-z])(?=.*[A-Z])[A-Za-z]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    # Of shorter ones, too many words of some languages would look even.
    "onecase": (r"^([a-z]{32,}|[A-Z]{32,})$", "abcdefghijklmnopqrstuvwxyz"),
}
# Coarse classes of each encoding's letters, as they are after ``cased``; what is in none of them is one more class.
CLASSES = {
    "hex": ["0123456789"],
    "base32": ["234567", "AEIOU"],
    "base36": ["0123456789", "aeiou"],
    "base64": ["0123456789+/", "AEIOU", "BCDFGHJKLMNPQRSTVWXYZ", "aeiou"],
    "letters": ["AEIOU", "BCDFGHJKLMNPQRSTVWXYZ", "aeiou"],
    "onecase": ["aeiou"],
}
PIECE, SEPARATORS = 20, "[-_+/]+"
TESTS = 4
ORDINARY_SHARE = 0.05
LOST_SHARE = 0.01
P_BINS = 1000
_SPANS = "array<struct<start:int,`end`:int,value:string,part:string>>"


def places(text: Column, pattern: str, group: int = 0) -> Column:
    """All matches as (start, end, value, part): code points, end exclusive; ``part`` is the group.

    The pieces between matches and the matches' lengths, added up in turn, give the places.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    rows = F.arrays_zip(F.transform(gaps, F.length).alias("gap"), found.alias("value"),
                        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("part"))
    none = F.array().cast(_SPANS)

    def step(a: Column, x: Column) -> Column:
        start = a["at"] + x["gap"]
        end = start + F.coalesce(F.length(x["value"]), F.lit(0))
        one = F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value"), x["part"].alias("part"))
        return F.struct(end.alias("at"), F.when(x["value"].isNull(), a["spans"])
                        .otherwise(F.concat(a["spans"], F.array(one)).cast(_SPANS)).alias("spans"))

    folded = F.aggregate(rows, F.struct(F.lit(0).alias("at"), none.alias("spans")), step, lambda a: a["spans"])
    return F.when(text.rlike(pattern), folded).otherwise(none)


def scanned(documents: DataFrame) -> DataFrame:
    """(doc_id, text_key, the spans of each pattern, candidates) of every row."""
    text = F.col("text")

    def found(pattern: str, group: int, least: int) -> Column:
        return F.filter(places(text, pattern, group), lambda s: F.length(s["part"]) >= least)

    kept = [found(*rule).alias(kind) for kind, rule in PATTERNS.items()]
    return texts(documents).select("doc_id", row_key(), *kept, places(text, CANDIDATE).alias("candidates"))


def _listed(kind: str, rank: int, spans: Column | str) -> Column:
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")))


def base_spans() -> Column:
    return F.sort_array(F.concat(*(_listed(kind, i, kind) for i, kind in enumerate(PATTERNS))))


# -- randomness tests --------------------------------------------------------------------------

def upper_tail(z: Column) -> Column:
    """Chance of a standard normal above ``z``, by its logistic approximation."""
    return 1 / (1 + F.exp(F.least(F.greatest(1.5976 * z + 0.070566 * z * z * z, F.lit(-300.0)), F.lit(300.0))))


def encoding(bare: Column) -> Column:
    return F.coalesce(*(F.when(bare.rlike(pattern), F.lit(name)) for name, (pattern, _) in ENCODINGS.items()))


def forms(token: Column) -> Column:
    """What of a candidate is tested: itself, or if it has no encoding its long pieces, or its letters and digits, unless they
    are words of one case, as in paths."""
    bare = F.regexp_replace(token, "=+$", "")
    pieces = F.filter(F.split(bare, SEPARATORS), lambda x: (F.length(x) >= PIECE) & encoding(x).isNotNull())
    return (F.when(encoding(bare).isNotNull(), F.array(token)).when(F.size(pieces) > 0, pieces)
            .otherwise(F.filter(F.array(F.regexp_replace(bare, SEPARATORS, "")), lambda x: encoding(x) != "onecase")))


def _z_of_chi(chi: Column, freedom: Column | int) -> Column:
    """Wilson and Hilferty's cube root."""
    ninth = F.lit(2 / 9) / freedom
    return (F.pow(chi / freedom, F.lit(1 / 3)) - (1 - ninth)) / F.sqrt(ninth)


def _z_of_classes(name: str) -> Column:
    """Of the chi-squared statistic of an encoding's classes, for the column ``cased``."""
    letters, listed = len(ENCODINGS[name][1]), CLASSES[name]
    seen = [F.length("cased") - F.length(F.translate("cased", found, "")) for found in listed]
    shares = [len(found) / letters for found in listed]
    rest = F.col("n")
    for one in seen:
        rest = rest - one
    chi = F.lit(0.0)
    for one, share in zip([*seen, rest], [*shares, 1 - sum(shares)]):
        chi = chi + F.pow(one - F.col("n") * share, F.lit(2.0)) / (F.col("n") * share)
    return _z_of_chi(chi, len(listed))


def with_p_values(tokens: DataFrame) -> DataFrame:
    """Adds ``encoding`` and ``p`` to rows with a ``token``; drops tokens without an encoding."""
    bare = F.regexp_replace("token", "=+$", "")
    kind = encoding(F.col("bare"))
    letters = F.create_map(*(F.lit(x) for name, (_, alphabet) in ENCODINGS.items() for x in (name, alphabet)))
    # One alphabet serves both cases of one-case encodings, and both forms of base 64.
    cased = (F.when(F.col("encoding").isin("hex", "base36", "onecase"), F.lower("bare"))
             .when(F.col("encoding") == "base64", F.translate("bare", "-_", "+/")).otherwise(F.col("bare")))
    rows = (tokens.withColumn("bare", bare).withColumn("encoding", kind).where("encoding IS NOT NULL")
            .withColumn("alphabet", letters[F.col("encoding")]).withColumn("cased", cased)
            .withColumn("codes", F.transform(F.array_remove(F.split("cased", ""), ""),
                                             lambda c: F.expr("0") + F.instr(F.col("alphabet"), c) - 1))
            .withColumn("n", F.size("codes").cast("double"))
            .withColumn("k", F.length("alphabet").cast("double")))
    codes, n, k = F.col("codes"), F.col("n"), F.col("k")
    # The j-th equal one in a row adds 2j - 1, so c equal ones add their square.
    squares = F.aggregate(
        F.sort_array(codes), F.struct(F.lit(-1).alias("last"), F.lit(0).alias("run"), F.lit(0.0).alias("sum")),
        lambda a, x: F.struct(
            x.alias("last"), F.when(a["last"] == x, a["run"] + 1).otherwise(F.lit(1)).alias("run"),
            (a["sum"] + F.when(a["last"] == x, 2.0 * a["run"] + 1).otherwise(F.lit(1.0))).alias("sum")),
        lambda a: a["sum"])
    walk = F.aggregate(
        codes, F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("high"), F.lit(0.0).alias("runs"),
                        F.lit(0.0).alias("serial")),
        lambda a, x: F.struct(
            x.alias("last"), (a["high"] + (2 * x >= k).cast("double")).alias("high"),
            (a["runs"] + ((a["last"] < 0) | ((2 * a["last"] >= k) != (2 * x >= k))).cast("double")).alias("runs"),
            (a["serial"] + F.when(a["last"] < 0, F.lit(0.0))
             .otherwise((a["last"] - (k - 1) / 2) * (x - (k - 1) / 2))).alias("serial")))
    rows = rows.withColumn("squares", squares).withColumn("walk", walk)
    chi = F.greatest(k / n * F.col("squares") - n, F.lit(0.0))
    z_chi = _z_of_chi(chi, k - 1)
    z_class = F.coalesce(*(F.when(F.col("encoding") == name, _z_of_classes(name)) for name in CLASSES))
    pairs = 2 * F.col("walk.high") * (n - F.col("walk.high"))
    spread = F.sqrt(F.greatest(pairs * (pairs - n) / (n * n * (n - 1)), F.lit(1e-9)))
    z_runs = F.abs(F.col("walk.runs") - (1 + pairs / n)) / spread
    z_serial = F.abs(F.col("walk.serial")) / ((k * k - 1) / 12) / F.sqrt(n - 1)
    p = TESTS * F.least(upper_tail(z_chi), upper_tail(z_class), 2 * upper_tail(z_runs), 2 * upper_tail(z_serial))
    return rows.withColumn("p", F.least(p, F.lit(1.0))).drop(
        "bare", "alphabet", "cased", "codes", "n", "k", "squares", "walk")


def strike_outs(tested: DataFrame) -> DataFrame:
    """(encoding, length_class, limit, strings, even, lost): p-values up to ``limit`` are struck out. Of the class's distinct
    ``strings`` about ``even`` are random, of which a share ``lost`` goes with the others. A few hundred rows at
    most, as there are six encodings and a class for each doubling of the length."""
    once = tested.select("encoding", "length_class", "mark", "p").distinct()
    bins = once.groupBy("encoding", "length_class", F.ceil(F.col("p") * P_BINS).alias("bin")).agg(
        F.count("*").alias("n"))
    low = int(LOST_SHARE * P_BINS)
    below = F.array(*(F.sum(F.when(F.col("bin") <= t, F.col("n")).otherwise(0)) for t in range(low + 1)))
    of_class = bins.groupBy("encoding", "length_class").agg(
        F.sum("n").alias("strings"), below.alias("below"),
        (2 * F.sum(F.when(F.col("bin") > P_BINS // 2, F.col("n")).otherwise(0))).alias("even"))
    # At each limit, the strings kept beyond the even ones among them.
    ordinary = F.transform("below", lambda n, t: F.col("strings") - n - F.col("even") * (1 - t / P_BINS))
    few = F.transform(ordinary, lambda x, t: x <= ORDINARY_SHARE * (F.col("strings") - F.col("below")[t]))
    first = F.array_position(few, True)
    limit = F.when(first > 0, (first - 1) / P_BINS).otherwise(F.lit(LOST_SHARE))
    return of_class.select("encoding", "length_class", limit.alias("limit"), "strings",
                           F.least("even", "strings").alias("even"), limit.alias("lost"))


def random_strings(scans: DataFrame) -> DataFrame:
    """(doc_id, text_key, random): the candidates of each row that pass as random and overlap no base span."""
    overlap = F.exists("base", lambda s: (s["start"] < F.col("c.end")) & (F.col("c.start") < s["end"]))
    tokens = (scans.where(F.size("candidates") > 0)
              .select("doc_id", "text_key", base_spans().alias("base"), F.explode("candidates").alias("c"))
              .where(~overlap)
              .select("doc_id", "text_key", F.col("c.start").alias("start"), F.col("c.end").alias("end"),
                      F.explode(forms(F.col("c.value"))).alias("token")))
    tested = stored(with_p_values(tokens).withColumn("length_class", F.floor(F.log2(F.length("token"))))
                    .withColumn("mark", F.xxhash64("token")).drop("token"), "tested")
    limits = F.broadcast(strike_outs(tested).select("encoding", "length_class", "limit"))
    return (tested.join(limits, ["encoding", "length_class"]).where("p > limit")
            .groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("start", "end")).alias("random")))


def secrets(documents: DataFrame) -> DataFrame:
    """(doc_id, text_key, base, spans) of every row; both lists hold (start, rank, end, kind), sorted."""
    scans = stored(scanned(documents), "scans")
    found = by_row(scans, random_strings(scans))
    none = F.array().cast("array<struct<start:int,`end`:int>>")
    more = _listed("random", len(PATTERNS), F.coalesce("random", none))
    return found.select("doc_id", "text_key", base_spans().alias("base"),
                        F.sort_array(F.concat(base_spans(), more)).alias("spans"))


def _text_of(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame) -> DataFrame:
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(kind).alias(f"n_{kind}") for kind in PATTERNS]
    return found.select("doc_id", *counts, F.sha2(_text_of("base").cast("binary"), 256).alias("base_sha256"),
                        _text_of("spans").alias("spans"))


def redacted(documents: DataFrame, mask: str = "[secret]") -> DataFrame:
    """``documents`` with all of their columns, each stretch of secrets in ``text`` replaced by ``mask``.

    Rows without secrets are left as they are, and a null text stays null.
    """
    found = secrets(documents).where(F.size("spans") > 0).select(
        F.col("doc_id").alias("_found_id"), F.col("text_key").alias("_found_key"), F.col("spans").alias("_spans"))
    found = found.dropDuplicates(["_found_id", "_found_key"])
    text = documents["text"].cast("string")
    key = F.xxhash64(F.coalesce(text, F.lit("")))
    cut = F.aggregate(
        "_spans", F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")),
        lambda a, s: F.struct(
            F.greatest(a["at"], s["end"]).alias("at"),
            F.when((s["start"] >= a["at"]) & ((a["at"] == 0) | (s["start"] > a["at"])), F.concat(
                a["out"], F.array(F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.lit(mask))))
            .otherwise(a["out"]).alias("out")),
        lambda a: F.concat(F.array_join(a["out"], ""), F.substring(text, a["at"] + 1, F.length(text))))
    joined = documents.join(
        found, documents["doc_id"].eqNullSafe(found["_found_id"]) & (key == found["_found_key"]), "left")
    return joined.withColumn("text", F.when(F.col("_spans").isNotNull(), cut).otherwise(text)).select(
        *documents.columns)
