"""URL filter: rules, then logistic regression on hashed n-grams (operator 10).

Only DataFrame functions.  A URL is read as host (after the first ``://`` up
to ``/``, ``?``, ``#`` or the end, A-Z in lower case) and path (then up to
``?``, ``#`` or the end); a null URL or one without ``://`` has neither.

* A rule ``host/path`` fits its host and all subdomains if the URL's path
  starts with the rule's path; the longest fitting rule decides.
* Other URLs are judged by a logistic regression on character n-grams of
  host and path, hashed into ``dims`` features.  It is trained by gradient
  descent on a small labelled table of URLs and returns at most ``dims``
  weights, which stand as a literal array in the scoring expression: scoring
  is a projection without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.common import materialise

#: rule -> verdict (fixed values)
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}

#: words of host names of the small labelled URL table, by subject (fixed values):
#: what public blocklists are about ...
BLOCKED_WORDS = (
    "casino", "poker", "roulette", "jackpot", "slots", "betting", "bets", "lottery", "bingo", "win",          # gambling
    "pills", "viagra", "cialis", "steroids", "slimming", "botox", "cheap", "discount", "replica", "fake",     # goods
    "adult", "porn", "xxx", "sexy", "escort", "singles", "webcam", "hookup", "nude", "fetish",                # adult
    "payday", "loans", "forex", "crypto", "profit", "cash", "rich", "prize", "giveaway", "free",              # money
    "ads", "track", "popup", "click", "banner", "adserver", "pixel", "affiliate", "traffic", "leads",         # advertising
    "spam", "linkfarm", "doorway", "malware", "phishing", "warez", "crack", "keygen", "torrent", "hack")      # abuse
#: ... and what other sites are about
ALLOWED_WORDS = (
    "library", "museum", "theatre", "gallery", "orchestra", "history", "poetry", "author", "novel", "letter",
    "garden", "kitchen", "leather", "furniture", "bakery", "butcher", "tailor", "carpenter", "florist", "potter",
    "weather", "mountain", "river", "forest", "island", "harbour", "north", "southern", "earth", "feather",
    "hospital", "health", "dentist", "therapy", "nursing", "mother", "brother", "father", "children", "family",
    "school", "student", "teacher", "lesson", "science", "physics", "theory", "method", "research", "institute",
    "railway", "station", "travel", "hotel", "bicycle", "sailing", "hiking", "camping", "airport", "journey",
    "council", "nation", "election", "justice", "police", "parliament", "statistics", "register", "energy", "water",
    "herald", "tribune", "times", "journal", "magazine", "opinion", "interview", "reader", "edition", "archive",
    "software", "engineer", "machine", "network", "notation", "solution", "threshold", "another", "together", "other",
    "thunder", "winter", "summer", "lantern", "anchor", "orient", "thistle", "hearth", "month", "tenth")
#: how words stand in host names; both classes have the same frames, ends and
#: paths, so that only the words make the difference
FRAMES = ("{}", "www.{}", "m.{}", "blog.{}")
PLAIN = ("site", "page", "online", "web", "portal", "home", "the", "my")
ENDS = ("example.com", "example.org", "example.net", "test", "invalid", "example")
PATHS = ("/", "/en/101", "/fr/7.html", "/page/2", "/de/330/", "/es/958", "/news/today", "/en/2290#top")


def _urls(words: tuple[str, ...], shifts: tuple[int, ...]) -> list[str]:
    """Each word joined with a plain word, and with the words ``shifts`` places on.

    Frames, ends and paths run through at different paces, so that each is as
    frequent in one class as in the other and goes with all words.
    """
    out = []
    for r, s in enumerate((0, *shifts)):
        for i, w in enumerate(words):
            k = i + 7 * r
            other = words[(i + s) % len(words)] if s else PLAIN[(i // 5) % len(PLAIN)]
            a, b = (w, other) if s or i % 2 else (other, w)
            name = f"{a}-{b}" if i % 3 else f"{a}{b}"
            out.append(f"http://{FRAMES[k // 3 % len(FRAMES)].format(name)}.{ENDS[k // 2 % len(ENDS)]}{PATHS[k % len(PATHS)]}")
    return out


LABELLED_URLS = [(u, 1) for u in _urls(BLOCKED_WORDS, (7,))] + [(u, 0) for u in _urls(ALLOWED_WORDS, (7, 23))]
#: other pairs of the words: the cutoff was chosen on the hosts that no labelled URL has
HELD_OUT_URLS = [(u, 1) for u in _urls(BLOCKED_WORDS, (11, 31))] + [(u, 0) for u in _urls(ALLOWED_WORDS, (11, 31))]

MAX_LABELLED = 2000
THRESHOLD = 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    rest = _rest(url)
    return F.regexp_extract(F.regexp_replace(rest, "^[^/?#]*", ""), "^[^?#]*", 0)


def fitting_rule(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits (the first in order on equal lengths), or null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), [-ord(c) for c in r])):
        h, p = rule[:rule.index("/")], rule[rule.index("/"):]
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def _grams(s: Column, mark: str, sizes: tuple[int, ...], dims: int) -> list[Column]:
    # the mark keeps host and path apart and stands for the beginning
    t = F.concat(F.lit(mark), s, F.lit("$"))

    def of_size(n: int) -> Column:
        # the lambda must have one parameter: transform gives a second one the place
        gram = lambda i: F.pmod(F.xxhash64(F.substring(t, i, F.lit(n))), F.lit(dims)).cast("int")
        return (F.when(F.length(t) >= n, F.transform(F.sequence(F.lit(1), F.length(t) - (n - 1)), gram))
                .otherwise(F.array().cast("array<int>")))

    return [of_size(n) for n in sizes]


def features(host: Column, path: Column, sizes: tuple[int, ...], dims: int) -> Column:
    """Distinct hashed n-grams of host and path."""
    return F.array_distinct(F.concat(*_grams(host, "^", sizes, dims), *_grams(path, "~", sizes, dims)))


def _probability(idx: Column, weights: Column, bias: float) -> Column:
    margin = F.aggregate(idx, F.lit(0.0), lambda s, i: s + F.get(weights, i))
    return 1.0 / (1.0 + F.exp(-(bias + margin / F.sqrt(F.greatest(F.size(idx), F.lit(1))))))


def _literal(values: list[float]) -> Column:
    """An array of numbers as one literal (folded when the query is planned)."""
    return F.split(F.lit(" ".join(f"{v:.6g}" for v in values)), " ").cast("array<double>")


def labelled_urls(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(u).alias("url"), F.lit(y).alias("blocked")) for u, y in LABELLED_URLS])))


def train(labelled: DataFrame, sizes: tuple[int, ...] = (3, 4, 5), dims: int = 1 << 16, steps: int = 600,
          rate: float = 6.0, penalty: float = 0.0001, max_labelled: int = MAX_LABELLED) -> tuple[list[float], float]:
    """labelled (url, blocked 0/1) -> weights and bias.

    Full-batch gradient descent with an L2 penalty from zero; the classes
    weigh as they occur.  The weights stay a combination of the labelled rows'
    features, so the descent runs on one coefficient per labelled row over
    the rows' inner products, as one fold over an array; the coefficients
    are then summed per feature.  At most
    ``max_labelled`` rows, as their inner products are one array.
    """
    rows = labelled.filter("url is not null and blocked is not null").select(
        F.col("blocked").cast("double").alias("y"),
        features(host_of(F.col("url")), path_of(F.col("url")), sizes, dims).alias("idx"))
    n, pos = rows.agg(F.count("*"), F.sum("y")).first()
    if n > max_labelled:
        raise ValueError(f"{n} labelled URLs; train takes at most {max_labelled}")
    if not n or not pos or pos == n:
        return [0.0] * dims, (8.0 if pos else -8.0)
    one = rows.agg(F.array_sort(F.collect_list(F.struct("y", F.lit(1.0 / n).alias("share"), "idx"))).alias("r"))
    # inner products; the constant 1 is the bias
    dot = F.transform("r", lambda a: F.transform("r", lambda b: 1.0 + F.size(F.array_intersect(a["idx"], b["idx"]))
                                                 / F.sqrt(F.size(a["idx"]) * F.size(b["idx"]))))

    def step(c, row, k):
        margin = F.aggregate(F.zip_with(row["dot"], c, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
        p = 1.0 / (1.0 + F.exp(-margin))
        return k - rate * ((p - row["y"]) * row["share"] + penalty * k)

    # written once: inside the fold the products would be worked out at every step
    both = materialise(one.select("r", F.zip_with("r", dot, lambda a, d: F.struct(
        a["y"].alias("y"), a["share"].alias("share"), d.alias("dot"))).alias("g")), "url-products")
    fitted = both.select("r", F.aggregate(
        F.sequence(F.lit(1), F.lit(steps)), F.transform("r", lambda _: F.lit(0.0)),
        lambda c, _: F.zip_with("g", c, lambda row, k: step(c, row, k))).alias("c"))
    per = fitted.select(F.inline(F.zip_with("r", "c", lambda a, k: F.struct(a["idx"].alias("idx"), k.alias("k")))))
    sums = per.select(F.explode(F.concat("idx", F.array(F.lit(-1)))).alias("i"),
                      "k", F.sqrt(F.size("idx")).alias("norm"))
    # index -1 gathers the bias
    w = {r.i: r.w for r in sums.groupBy("i").agg(F.sum(
        F.when(F.col("i") < 0, F.col("k")).otherwise(F.col("k") / F.col("norm"))).alias("w")).collect()}
    return [w.get(i, 0.0) for i in range(dims)], w[-1]


def filter_urls(pages: DataFrame, labelled: DataFrame | None = None, rules: dict[str, str] = RULES,
                sizes: tuple[int, ...] = (3, 4, 5), dims: int = 1 << 16, threshold: float = THRESHOLD) -> DataFrame:
    """pages (url, ...) -> the same rows with host, path, rule, verdict and
    score (the model's probability of ``block``); ``url`` and ``html`` go."""
    w, bias = train(labelled if labelled is not None else labelled_urls(pages.sparkSession), sizes, dims)
    kept = [c for c in pages.columns if c.lower() not in ("url", "html", "host", "path", "rule", "verdict", "score")]
    read = pages.select(*kept, host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    read = read.select(*kept, F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"))
    judged = read.select(
        *kept, "host", "path", fitting_rule(F.col("host"), F.col("path"), rules).alias("rule"),
        _probability(features(F.col("host"), F.col("path"), sizes, dims), _literal(w), bias).alias("score"))
    verdict = F.when(F.col("score") >= threshold, "block").otherwise("allow")
    for rule, v in rules.items():
        verdict = F.when(F.col("rule") == rule, v).otherwise(verdict)
    return judged.withColumn("verdict", verdict)
