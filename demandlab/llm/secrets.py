"""Secret scan with DataFrame functions only: fixed formats and a randomness test battery.

Fixed formats are assignments to a secret-like name, access key ids and long hex runs.
A text is split at a format's matches; the lengths of pieces and matches give the
positions, in code points.

The battery looks at every run of 20 or more characters of the usual encodings:

- the encoding is inferred (hex, base32, upper-case letters and digits, base64) and gives the alphabet;
- three tests of "uniformly random over that alphabet": chi-squared of the symbol
  counts, runs above and below the middle of the alphabet, serial correlation of
  neighbours. A token that any of them rejects (Bonferroni) is no secret;
- two tests of "a run of ordinary text": fewer repeated symbols than letters of
  words have, and more changes of character class than words have. Their combined
  p-values (Fisher) are held against all tokens of the corpus in the same stratum of
  length by the Benjamini-Hochberg rule, so long runs of letters do not become
  findings however many there are.

The rule needs counts of p-values per stratum, not their order: p-values fall into
bins of a twentieth of a power of ten, each as large as its upper bound. The table of
bins is bounded by (strata x bins).

Defined cases: null text is empty; empty texts have no spans; rows are never joined,
so repeated or null ids are rows of their own; input columns named like results
are replaced; an empty table has no thresholds and no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlab.llm.common import table

# The formats of the contract.
ASSIGN = (r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
          r"""([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{12,}"  # the longest run from its first AKIA, as with + and a later test of its length
HEX = r"[0-9a-f]{32,}"
ASSIGN_CHARS = 8
KINDS = ("assign", "access", "hex", "random")

TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
# Ordinary text: chance that two letters agree, that three agree, that neighbours in a word differ in class.
TWO_AGREE, THREE_AGREE, CLASS_CHANGE = 0.065, 0.0055, 0.01
REJECT = 0.001
DISCOVERY_RATE = 0.01
BINS_PER_DECADE = 20
LAST_BIN = 2000
STRATA = (20, 24, 32, 48, 64, 128)

DIGITS, UPPER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ALPHABETS = {16: DIGITS + "abcdef", 32: UPPER + "234567", 36: DIGITS + UPPER,
             64: UPPER + UPPER.lower() + DIGITS + "+/"}
SPAN = "struct<start:bigint,end:bigint>"


def _positions(text: Column, pattern: str, kept=None) -> Column:
    """Spans of the pattern's matches; ``kept(first group)`` may refuse a match."""
    pieces = F.split(text, pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    group = F.regexp_extract_all(text, F.lit(pattern), F.lit(1)) if kept else whole
    each = F.arrays_zip(pieces.alias("piece"), whole.alias("match"), group.alias("part"))
    none = F.array().cast(f"array<{SPAN}>")

    def step(a, x):
        low = a["at"] + F.length(x["piece"])
        high = low + F.coalesce(F.length(x["match"]), F.lit(0))
        good = x["match"].isNotNull() & (kept(x["part"]) if kept else F.lit(True))
        return F.struct(high.cast("long").alias("at"), F.when(
            good, F.concat(a["out"], F.array(F.struct(low.cast("long").alias("start"), high.cast("long").alias("end")))))
            .otherwise(a["out"]).alias("out"))

    found = F.aggregate(each, F.struct(F.lit(0).cast("long").alias("at"), none.alias("out")), step, lambda a: a["out"])
    return F.when(text.rlike(pattern), found).otherwise(none)


def _log_normal(z: Column) -> Column:
    """ln of the normal distribution function, by the logistic approximation with a cubic term."""
    x = 1.5976 * z + 0.070566 * z * z * z
    return F.when(x < -30, x).otherwise(-F.log1p(F.exp(-x)))


def _with(items: Column, **made) -> Column:
    """Adds fields to the structs of an array; each value is a function of the struct before."""
    def extended(x: Column) -> Column:
        out = x
        for name, value in made.items():
            out = out.withField(name, value(x))
        return out

    return F.transform(items, extended)


def _per_alphabet(x: Column, make) -> Column:
    out = make(64)
    for k in (36, 32, 16):
        out = F.when(x["size"] == k, make(k)).otherwise(out)
    return out


def _squares(x: Column, k: int) -> Column:
    counts = [F.length(x["word"]) - F.length(F.translate(x["word"], c, "")) for c in ALPHABETS[k]]
    return F.aggregate(F.array(*counts), F.lit(0.0), lambda a, c: a + (c * c).cast("double"))


def _values(x: Column, k: int) -> Column:
    return F.transform(F.split(x["word"], ""), lambda c: F.instr(F.lit(ALPHABETS[k]), c).cast("double"))


def _lag_sums(x: Column) -> Column:
    start = F.struct(F.lit(0.0).alias("cross"), F.lit(0.0).alias("square"), F.lit(0.0).alias("last"))
    return F.aggregate(x["values"], start, lambda a, v: F.struct(
        (a["cross"] + a["last"] * (v - x["mean"])).alias("cross"),
        (a["square"] + (v - x["mean"]) * (v - x["mean"])).alias("square"), (v - x["mean"]).alias("last")))


def _classes(x: Column) -> Column:
    out = x["core"]
    for chars, sign in (("[a-z]+", "a"), ("[A-Z]+", "A"), ("[0-9]+", "0"), ("[+/]+", "+")):
        out = F.regexp_replace(out, chars, sign)
    return F.length(out).cast("double")


def _stratum(x: Column) -> Column:
    out = F.lit(0)
    for i, low in enumerate(STRATA):
        out = F.when(x["n"] >= low, i).otherwise(out)
    return out


def _log_repeats(x: Column) -> Column:
    return _log_normal(((x["squared"] - x["n"]) / 2 - x["pairs"] * TWO_AGREE) / F.sqrt(
        x["pairs"] * TWO_AGREE * (1 - TWO_AGREE)
        + 2 * x["pairs"] * (x["n"] - 2) * (THREE_AGREE - TWO_AGREE * TWO_AGREE)))


def _log_changes(x: Column) -> Column:
    share = x["share"]
    bound = -(x["n"] - 1) * (share * F.log(share / CLASS_CHANGE)
                             + (1 - share) * F.log((1 - share) / (1 - CLASS_CHANGE)))
    return F.when(share > CLASS_CHANGE, bound).otherwise(0.0)


def _tokens(text: Column) -> Column:
    """array of (start, end, random, stratum, bin) of the long runs.

    Each step reads what the step before has put into the struct.
    """
    found = F.transform(_positions(text, TOKEN), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), F.translate(F.regexp_replace(
            F.substring(text, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")), "=+$", ""),
            "-_=", "+/+").alias("core")))
    found = F.filter(found, lambda x: F.length(x["core"]) > 2)
    found = _with(found, n=lambda x: F.length(x["core"]).cast("double"),
                  hexed=lambda x: x["core"].rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), classes=_classes)
    found = _with(found, size=lambda x: F.when(x["hexed"], 16).when(x["core"].rlike("^[A-Z2-7]+$"), 32)
                  .when(x["core"].rlike("^[A-Z0-9]+$"), 36).otherwise(64),
                  word=lambda x: F.when(x["hexed"], F.lower(x["core"])).otherwise(x["core"]),
                  pairs=lambda x: x["n"] * (x["n"] - 1) / 2, stratum=_stratum,
                  share=lambda x: F.least((x["classes"] - 1) / (x["n"] - 1), F.lit(0.9999)))
    found = _with(found, squared=lambda x: _per_alphabet(x, lambda k: _squares(x, k)),
                  values=lambda x: _per_alphabet(x, lambda k: _values(x, k)),
                  halves=lambda x: _per_alphabet(x, lambda k: F.translate(
                      x["word"], ALPHABETS[k], "0" * (k // 2) + "1" * (k - k // 2))),
                  spread=lambda x: 2.0 / (9.0 * (x["size"] - 1)))
    found = _with(found, mean=lambda x: F.aggregate(x["values"], F.lit(0.0), lambda a, v: a + v) / x["n"],
                  ones=lambda x: F.length(F.translate(x["halves"], "0", "")).cast("double"),
                  runs=lambda x: F.length(F.regexp_replace(F.regexp_replace(x["halves"], "0+", "a"), "1+", "b"))
                  .cast("double"),
                  chi=lambda x: x["size"] / x["n"] * x["squared"] - x["n"],
                  log_repeats=_log_repeats, log_changes=_log_changes)
    found = _with(found, both=lambda x: 2 * x["ones"] * (x["n"] - x["ones"]), lag=_lag_sums,
                  z_chi=lambda x: (F.pow(F.greatest(x["chi"], F.lit(0.0)) / (x["size"] - 1), F.lit(1 / 3))
                                   - (1 - x["spread"])) / F.sqrt(x["spread"]),
                  evidence=lambda x: -(x["log_repeats"] + x["log_changes"]))
    found = _with(found, variance=lambda x: x["both"] * (x["both"] - x["n"]) / (x["n"] * x["n"] * (x["n"] - 1)),
                  correlation=lambda x: F.when(x["lag"]["square"] > 0, x["lag"]["cross"] / x["lag"]["square"])
                  .otherwise(1.0), log_p=lambda x: F.log1p(x["evidence"]) - x["evidence"])
    found = _with(found, z_runs=lambda x: F.when(x["variance"] > 0, F.abs(x["runs"] - (x["both"] / x["n"] + 1))
                                                 / F.sqrt(x["variance"])).otherwise(9.0),
                  z_serial=lambda x: F.abs(x["correlation"] + 1 / x["n"]) * F.sqrt(x["n"]))
    return F.transform(found, lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"),
        (F.least(_log_normal(-x["z_chi"]), _log_normal(-x["z_runs"]) + F.log(F.lit(2.0)),
                 _log_normal(-x["z_serial"]) + F.log(F.lit(2.0))) + F.log(F.lit(3.0)) >= F.log(F.lit(REJECT)))
        .alias("random"), x["stratum"].alias("stratum"),
        F.least(F.floor(-x["log_p"] / F.log(F.lit(10.0)) * BINS_PER_DECADE), F.lit(LAST_BIN)).cast("int").alias("bin")))


def discovery_bins(docs: DataFrame, rate: float = DISCOVERY_RATE) -> list[int]:
    """Per stratum of length the smallest bin that the Benjamini-Hochberg rule discovers.

    One row per (stratum, bin) reaches the driver at most.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    tokens = docs.where(text.rlike(TOKEN)).select(F.explode(_tokens(text)).alias("t"))
    counts = tokens.groupBy(F.col("t.stratum").alias("s"), F.col("t.bin").alias("b")).count().collect()
    cuts = [LAST_BIN + 1] * len(STRATA)
    for s in range(len(STRATA)):
        mine = sorted(((r["b"], r["count"]) for r in counts if r["s"] == s), reverse=True)
        total, seen = sum(c for _, c in mine), 0
        for b, c in mine:
            seen += c
            if 10.0 ** (-b / BINS_PER_DECADE) * total <= rate * seen:
                cuts[s] = b
    return cuts


def find_secrets(docs: DataFrame, rate: float = DISCOVERY_RATE) -> DataFrame:
    """``docs`` with ``secrets``: array of (start, kind_no, end) in order, kind_no an index of KINDS."""
    cuts = F.array(*[F.lit(c) for c in discovery_bins(docs, rate)])
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))

    def named(spans: Column, kind: int) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind_no"),
                                                     s["end"].alias("end")))

    fixed = F.concat(named(_positions(text, ASSIGN, lambda v: F.length(v) >= ASSIGN_CHARS), 0),
                     named(_positions(text, ACCESS), 1), named(_positions(text, HEX), 2))
    found = docs.withColumns({"_fixed": fixed, "_tokens": _tokens(text)})
    fresh = F.filter("_tokens", lambda t: t["random"] & (t["bin"] >= F.get(cuts, t["stratum"]))
                     & ~F.exists("_fixed", lambda f: (f["start"] < t["end"]) & (t["start"] < f["end"])))
    return found.withColumn("secrets", F.array_sort(F.concat("_fixed", named(fresh, 3)))).drop("_fixed", "_tokens")


def redact(found: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """Replaces every span of ``secrets`` in ``text``; overlapping spans become one mark."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(a, x):
        gap = F.substring("text", (a["at"] + 1).cast("int"), (x["start"] - a["at"]).cast("int"))
        return F.struct(F.greatest(a["at"], x["end"]).alias("at"), F.when(
            (x["start"] >= a["at"]), F.concat(a["out"], gap, F.lit(mark))).otherwise(a["out"]).alias("out"))

    clean = F.aggregate("secrets", start, step, lambda a: F.concat(
        a["out"], F.substring("text", (a["at"] + 1).cast("int"), F.length("text"))))
    return found.withColumn("text", F.when(F.size("secrets") > 0, clean).otherwise(F.col("text")))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["kind_no"] + 1), s["start"].cast("string"),
        s["end"].cast("string"))), ",")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    found = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "secrets")

    def count(kind: int) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind_no"] == kind)).cast("long")

    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(_joined(F.filter("secrets", lambda s: s["kind_no"] < 3)), 256).alias("base_sha256"),
                        _joined(F.col("secrets")).alias("spans"))
