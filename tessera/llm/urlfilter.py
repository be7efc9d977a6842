"""URL filter: rules first, then a classifier for what no rule fits.

The classifier is a logistic regression on hashed character n-grams of host and
path, trained from a small labelled table (about 1,200 URLs, made by rule from
word lists). Parsing, rules, n-grams, hashing and
prediction are DataFrame and MLlib operations.
"""

from __future__ import annotations

import random

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import quoted

#: Lengths of the n-grams and number of hash slots.
GRAMS, SLOTS = (3, 4, 5), 1 << 16

#: What the labelled table is made of: words that name what a host sells, by family, ...
FAMILIES = {
    "gambling": "casino poker slots roulette jackpot blackjack betting stakes wager lotto bingo odds".split(),
    "pharmacy": "pills pharmacy meds viagra cialis tablets drugstore painkiller steroids dosage rx generics".split(),
    "adult": "adult porn xxx sex cams nude erotic escort webcam milf fetish hookup".split(),
    "credit": "loans payday credit lender debt refinance mortgage cash advance forex trading crypto".split(),
    "warez": "crack warez keygen torrent serials nulled cracked patch mod apk rip downloads".split(),
    "fakes": "replica rolex handbags watches knockoff designer outlet sneakers luxury jersey copies brand".split(),
    "links": "spam links backlinks seo traffic clicks farm mailer bulk directory promo submit".split(),
    "tracking": "ads track tracker adserver pixel banner affiliate popunder analytics beacon tag redirect".split(),
}
#: ... words that push it, ...
PUSH = "cheap free best win online hot bonus deal instant easy".split()
#: ... and pages of such hosts; ordinary subjects, and pages of ordinary hosts.
PUSH_PAGES = "buy-now order-now bonus-now play-now click-now join-now free-offer best-offer cheap-offer win-offer".split()
SUBJECTS = ("library museum garden school history weather travel music science village river mountain kitchen bakery theatre football "
            "hospital council market harbour forest winter summer language poetry painting bicycle railway astronomy chemistry biology "
            "archive parish teacher student journal review gazette herald tribune observer monitor chronicle bulletin almanac atlas").split()
SYLLABLES = "al an be bor ca den el er fa gan hal in ka la lin ma mer na nor o pa quen ra ri sa sel ta tor un ver wen ya zo th the he es ing ion ent her ed st".split()
PAGES = "en fr de es it news about docs articles topics archive people events guide".split()
ZONES = "com org net info biz co.uk de fr es edu".split()


def labelled_urls(without: str | None = None, seed: int = 5) -> list[tuple[str, float]]:
    """The labelled table: URLs and 1.0 (to be blocked) or 0.0, made by rule from
    the words above; ``without`` leaves out one family. Hosts of both kinds come
    with and without hyphens, subdomains, numbered and language pages, so that
    words and the habit of pushing decide, not the form."""
    rng = random.Random(seed)
    pick = rng.choice
    front = lambda: pick(["", "", "", "www.", "m.", "blog."])
    plain = lambda: pick(["", f"/{pick(PAGES)}/{rng.randint(1, 999)}", f"/{pick(PAGES)}/{rng.randint(1, 99)}.html", f"/{pick(PAGES)}/{pick(SUBJECTS)}", "/"])
    out = []
    for family, words in FAMILIES.items():
        for word in words:
            for k in range(6):
                parts = [word, pick([pick(words), "x", "farm", "24"] if k == 5 else PUSH)]
                rng.shuffle(parts)
                host = pick(["-", "-", ""]).join(parts) + "." + pick([pick(ZONES), "example." + pick(["com", "org", "net"])])
                page = f"/{pick(PUSH_PAGES)}" if k < 2 else plain()
                if family != without:
                    out.append((f"https://{front()}{host}{page}", 1.0))
    for _ in range(600):
        made = "".join(pick(SYLLABLES) for _ in range(rng.randint(2, 4)))
        name = pick([made, made, pick(SUBJECTS), f"{pick(SUBJECTS)}-{pick(SUBJECTS)}", f"{made}-{pick(SUBJECTS)}", pick(SUBJECTS) + pick(SUBJECTS)])
        host = pick([name + "." + pick(ZONES), f"{name}.example." + pick(["com", "org", "net"]), "example." + pick(["com", "org", "net"])])
        out.append((f"https://{front()}{host}{plain()}", 0.0))
    return out


def host_of(url: Column) -> Column:
    """What lies between the first ``://`` and ``/``, ``?``, ``#`` or the end, with A-Z lower-cased; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def grams(host: Column, path: Column) -> Column:
    """Character n-grams of host and path, marked by where they come from."""

    def cut(mark: str, text: Column, n: int) -> Column:
        starts = F.sequence(F.lit(1), F.length(text) - (n - 1))
        found = F.transform(starts, lambda i: F.concat(F.lit(mark), text.substr(i, F.lit(n))))
        return F.when(F.length(text) >= n, found).otherwise(F.array().cast("array<string>"))

    dotted = F.concat(F.lit("."), host, F.lit("."))
    return F.array_distinct(F.concat(*[cut("h", dotted, n) for n in GRAMS], *[cut("p", path, n) for n in GRAMS]))


def _vectors(rows: DataFrame, host: str, path: str) -> DataFrame:
    tf = HashingTF(inputCol="__grams", outputCol="__vector", numFeatures=SLOTS, binary=True)
    return tf.transform(rows.withColumn("__grams", grams(F.col(host), F.col(path))))


def fit(spark: SparkSession, labelled: list[tuple[str, float]] | None = None, ridge: float = 0.003) -> LogisticRegressionModel:
    """Train on labelled URLs, by default ``labelled_urls()``."""
    rows = spark.createDataFrame(labelled if labelled is not None else labelled_urls(), "url string, label double")
    rows = rows.coalesce(1).select(host_of(F.col("url")).alias("h"), path_of(F.col("url")).alias("p"), "label")
    lr = LogisticRegression(featuresCol="__vector", regParam=ridge, maxIter=60, standardization=False)
    return lr.fit(_vectors(rows, "h", "p"))


def rule_for(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    """The longest rule ``host/path`` that fits, as a struct of rule and verdict, or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # the longest is tried first
        at = rule.index("/")
        own, start = rule[:at].lower(), rule[at:]
        fits = ((host == own) | F.endswith(host, F.lit(f".{own}"))) & F.startswith(path, F.lit(start))
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def judge(pages: DataFrame, model: LogisticRegressionModel, rules: tuple[tuple[str, str], ...], url_col: str = "url",
          keep: tuple[str, ...] = (), threshold: float = 0.5) -> DataFrame:
    """One row per row: the columns ``keep``, then ``host, path, rule, verdict,
    block_score``. ``rules`` are (verdict, ``host/path``); a rule fits its host
    and all subdomains where the path starts with the rule's, and the longest
    decides (of equally long ones the last by name). No rule: blocked if the
    classifier's probability is ``threshold`` or more. Null URLs and URLs without ``://`` have
    an empty host and path, which no rule fits and the classifier judges.
    Repeated rows give repeated rows; very long URLs are judged whole; columns
    that are not kept are not read; no rows give no rows.
    """
    url = F.col(url_col).cast("string")
    rows = pages.select(F.struct(*quoted(keep)).alias("__keep") if keep else F.lit(None).alias("__keep"),
                        host_of(url).alias("__h"), path_of(url).alias("__p"))
    lr = model.copy().setFeaturesCol("__vector").setProbabilityCol("__p1").setRawPredictionCol("").setPredictionCol("")
    made = lr.transform(_vectors(rows, "__h", "__p"))
    score = vector_to_array("__p1")[1]
    rule = rule_for(F.col("__h"), F.col("__p"), rules)
    verdict = F.coalesce(rule["verdict"], F.when(score >= threshold, "block").otherwise("allow"))
    return made.select(*[F.col(f"__keep.`{c}`").alias(c) for c in keep], F.col("__h").alias("host"), F.col("__p").alias("path"),
                       rule["rule"].alias("rule"), verdict.alias("verdict"), score.alias("block_score"))
