"""URL filters: rules by host and path, and logistic regression on hashed character n-grams.

DataFrame expressions and Spark ML only. Host and path give n-grams of three to five characters
with a mark of their part and of its ends; the host's labels and the words in them come on top as
n-grams of their own length. Each part's are hashed into a fixed number of features and normed, so
that neither long URLs nor long paths outweigh the rest. The regression is trained from a small labelled table of
URLs, and judges what no rule fits.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import HashingTF, Normalizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SIZES = (3, 4, 5)
FEATURES = 1 << 14
#: The best of PENALTIES by :func:`cross_validate`, over the labelled table before its last widening.
PENALTY = 1e-5
#: Rounds of the regression; each is a Spark job.
ROUNDS = 30
PENALTIES = (1e-2, 1e-3, 1e-4, 1e-5)
FOLDS = 5

# The rules as (verdict, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

# The labelled table of URLs.
ALLOWED = """
https://www.riverlibrary.example.net/en/412
https://blog.gardenpath.example.com/en/77.html
http://m.citymuseum.example.net/de/90
https://news.harbour.example.com/en/2021/council-vote
https://docs.toolkit.example.net/guide/install.html
https://university.example.com/research/papers/12
http://www.weather.example.net/fr/forecast/
https://blog.kitchen.example.com/es/recetas/44
https://wiki.history.example.net/en/battle_of_hastings
https://shop.bookstore.example.com/en/catalogue?page=2
http://school.example.net/en/timetable#monday
https://m.trainlines.example.com/en/stations/18/
https://health.clinic.example.net/en/opening-hours
https://open.datasets.example.com/tables/population.csv
http://archive.photos.example.net/1998/summer/
https://code.samples.example.com/python/sorting
https://www.localpaper.example.net/sport/results
https://forum.cyclists.example.com/thread/9931
""".split()
BLOCKED = """
https://www.cheap-pills.example.com/en/450
http://cheap-meds.example.net/buy/now
https://spam-farm.example.net/en/728?utm_source=feed
http://link-farm.example.com/en/1/
https://casino-bonus.example.net/free-spins
http://www.online-casino.example.com/en/jackpot
https://free-money.example.net/click-here
http://win-big-lottery.example.com/prize/claim
https://adult-cams.example.net/live
http://xxx-videos.example.com/watch/12
https://viagra-shop.example.net/order?discount=90
http://replica-watches.example.com/cheap/rolex
https://crack-keygen.example.net/download.exe
http://warez-torrent.example.com/full/movie
https://login-verify-account.example.net/secure/update
http://paypa1-security.example.com/signin
https://ad-tracker.example.net/pixel?click=1
http://spam-links.example.com/seo/backlinks
https://www.pills-online.example.net/de/77
http://poker-farm.example.com/bet
https://loan-now.example.net/instant-cash
http://cheap-seo.example.com/rank/1
https://m.spam-offers.example.net/fr/12
http://get-rich-quick.example.com/bonus
""".split()

# Words of ordinary and of unwanted hosts, syllables of made-up names, and paths that both share.
ORDINARY = """
library garden museum harbour tool weather kitchen history book school train clinic data photo code paper cycle city council water quality
river mountain travel music theatre science physics biology chemistry math language grammar poetry novel recipe baker coffee tea farm orchard
forest bird fish whale horse dog cat health hospital nurse dental care diabetes alphabet freedom address advice advocate essex sussex track-field
winter window twin credit bank savings law court police fire station bus rail airport hotel camping bridge tower castle church temple art gallery
paint design fashion shoe wood metal glass stone car motor bike boat sail swim run football tennis chess game puzzle toy child family parent
wedding house home roof energy solar wind climate earth space star planet moon sun radio news journal review research college academy student
teacher lesson exam job career office market trade export industry steel paper-mill bakery brewery wine cheese fruit nut seed honey spice salt
open public national local world europe north south east west old new green blue red white black wiki forum archive docs support status mail
acoustics almanac anatomy animals apple archery atlas autumn balcony ballet bamboo basket beach berry bicycle biscuit botany bread breeze bright
brook butter cabin calendar candle canvas carpenter cellar century ceramics chapel charity cherry circle citizen cliff clock cloud clover coast
comet compass concert copper coral cotton country cousin craft creek crystal curtain dawn deer delta desert dialect dinner doctor dolphin drama
dream driver eagle editor elephant engine evening fabric feather festival-hall fiction field flower folklore fountain fox frost furniture gate
gazette geometry glacier globe granite grass guide guitar hammer hedge herb hill horizon hunter idea insect island ivory jacket jungle kettle
kingdom ladder lake lamp landscape lantern laurel leaf lemon letter linen lizard logic magazine manor maple marble meadow medicine melody mentor
meteor mill mineral mirror moss museum-shop nature needle nest notebook oak ocean olive onion opera orange otter oxygen palace parade parrot
pasture path pearl pencil pepper piano picnic pillow pine planet-earth plaza pond portrait potato quarry quilt rabbit rain reader record reef
region rope rose saddle sailor scholar sculpture senate shadow shell shepherd silk silver sketch snow soup spring stable statistics storm
summer tailor teapot temple-yard thunder tiger timber tomato torch tradition tribune tulip turtle union valley vegetable village violin vineyard
voice voyage wagon walnut waterfall weaver wheat willow wool workshop yard zebra zoology
""".split()
UNWANTED = """
casino poker bet bets betting jackpot slots lottery bingo roulette gamble win bonus prize winner pills pharma meds viagra cialis steroids adult
porn sex cams nude xxx escort dating-hot hookup spam ads ad adserver track tracker tracking click clicks popup banner pixel affiliate crack keygen
warez torrent pirate serials nulled malware virus phish hack hacked verify-account login-secure signin-update wallet-unlock loan loans payday
instant-cash quick-money money rich get-rich bitcoin-double invest-now cheap free discount deal-hot replica fake rolex followers likes seo backlinks
link-farm linkfarm content-farm spin miracle diet-pill slim-fast weightloss offer offers promo gift-card survey-reward
casinos gambling gamblers wager blackjack betsafe pokies stake lotto raffle pharmacy drugstore xanax tramadol opioid sexy erotic fetish camgirl
onlyfans stripper hentai porno sexcam singles adserv adclick adnetwork advert-banner spammer spamming clickbait clickfraud cracks cracked keys-free
torrents warezhub rapid-leech trojan ransom stealer botnet scam scams fraud creditfix quickloan cashloan cash-now millionaire double-your forex-win
bitcoin-giveaway crypto-pump counterfeit knockoff designer-fake fakes buy-likes buy-views traffic-bot seo-rank backlink pagerank linkexchange
""".split()
SYLLABLES = "th er in on an re he nd ti es or te ed is it al ar st en at le ve ra ro li co me de ha wh ble tion ing ent ter con sh be no ca mo pe lu so".split()
ENDINGS = "s -online 24 hub er 4u -club ing world -city -net land".split()
PATHS = "/en/{n} /de/{n}/ /fr/{n}.html /es/{n}?page=2&ref=x /en/{n}#top /{n}?utm_source=feed / /index.html".split()


def _urls(hosts: list[str], first: int) -> list[str]:
    """A URL of each host: prefixes, domains and paths go round, alike for both labels."""
    return [f"{('https', 'http')[i % 2]}://{('', 'www.', 'm.', 'blog.', '')[i % 5]}{host}.example.{('com', 'net')[i % 3 % 2]}"
            f"{PATHS[i % len(PATHS)].format(n=i * 37 % 9973)}" for i, host in enumerate(hosts, first)]


def _pairs(words: list[str]) -> list[str]:
    """Hosts of two words each, joined by a hyphen or not."""
    return [w + "-"[:i % 2] + words[(i * 7 + 11) % len(words)] for i, w in enumerate(words)]


def _endings(words: list[str]) -> list[str]:
    """Hosts of a word and a common ending, the same for both labels."""
    return [w + ENDINGS[i % len(ENDINGS)] for i, w in enumerate(words)]


def _names(count: int) -> list[str]:
    """Made-up names of two to four syllables."""
    n = len(SYLLABLES)
    return ["".join(SYLLABLES[(i * (k + 3) + i // n * (k * 5 + 1) + k * 17) % n] for k in range(2 + i % 3)) for i in range(count)]


ALLOWED += (_urls(ORDINARY, 0) + _urls(_pairs(ORDINARY), 1) + _urls(_endings(ORDINARY), 2) + _urls(_pairs(ORDINARY[::-1]), 3) + _urls(_names(400), 4))
BLOCKED += (_urls(UNWANTED, 0) + _urls(_pairs(UNWANTED), 1) + _urls(_endings(UNWANTED), 2)
            + _urls([f"{w}-{ORDINARY[i * 5 % len(ORDINARY)]}" for i, w in enumerate(UNWANTED)], 3)
            + _urls([ORDINARY[i * 3 % len(ORDINARY)] + "-"[:i % 2] + w for i, w in enumerate(UNWANTED)], 4))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits host and path, null where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, at, begin in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(begin)
        name = F.when(fits, F.lit(at + begin)).otherwise(name)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


def grams(host: Column, path: Column) -> tuple[Column, Column]:
    """N-grams of host and path; the host's with its labels and words."""
    def of(text: Column, size: int) -> Column:
        held = F.concat(F.lit("^"), text, F.lit("$"))
        last = F.length(held) - (size - 1)
        return F.when(last >= 1, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substring(held, i, F.lit(size)))
                      ).otherwise(F.array().cast("array<string>"))
    words = (F.transform(F.split(host, by), lambda w: F.concat(F.lit("w:"), w)) for by in (r"\.", r"[.\-]"))
    return F.concat(*words, *(of(host, size) for size in SIZES)), F.concat(*(of(path, size) for size in SIZES))


def _features(rows: DataFrame, host: str, path: str, out: str) -> DataFrame:
    parts, columns = [], rows.columns
    for part, found in zip(("host", "path"), grams(F.col(host), F.col(path)), strict=True):
        rows = rows.withColumn(f"{out}_{part}_grams", found)
        rows = HashingTF(inputCol=f"{out}_{part}_grams", outputCol=f"{out}_{part}_counts", numFeatures=FEATURES, binary=True).transform(rows)
        rows = Normalizer(inputCol=f"{out}_{part}_counts", outputCol=f"{out}_{part}").transform(rows)
        parts.append(f"{out}_{part}")
    return VectorAssembler(inputCols=parts, outputCol=out).transform(rows).select(*columns, out)


def labelled(spark: SparkSession, allowed=ALLOWED, blocked=BLOCKED) -> DataFrame:
    """(label, host, path, features) of a labelled table of URLs; label 1 blocks."""
    rows = spark.createDataFrame([(u, 0.0) for u in allowed] + [(u, 1.0) for u in blocked], "url string, label double").coalesce(1)
    rows = rows.select("label", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    return _features(rows, "host", "path", "features")


def _regression(penalty=PENALTY) -> LogisticRegression:
    return LogisticRegression(regParam=penalty, maxIter=ROUNDS, standardization=False)


def train(spark: SparkSession, allowed=ALLOWED, blocked=BLOCKED) -> LogisticRegressionModel:
    """The regression over a labelled table; label 1 blocks."""
    return _regression().fit(labelled(spark, allowed, blocked))


def cross_validate(spark: SparkSession, penalties=PENALTIES, folds=FOLDS, allowed=ALLOWED, blocked=BLOCKED) -> dict[float, float]:
    """Mean area under the ROC curve of each penalty over folds of a labelled table; a host's fold is by its hash."""
    rows = labelled(spark, allowed, blocked).withColumn("fold", F.pmod(F.xxhash64("host"), F.lit(folds)).cast("int"))
    regression = _regression()
    grid = ParamGridBuilder().addGrid(regression.regParam, penalties).build()
    found = CrossValidator(estimator=regression, estimatorParamMaps=grid, evaluator=BinaryClassificationEvaluator(), numFolds=folds,
                           foldCol="fold").fit(rows)
    return dict(zip(penalties, found.avgMetrics, strict=True))


def filter_urls(pages: DataFrame, model: LogisticRegressionModel, id_col="page_id", url_col="url", rules=RULES) -> DataFrame:
    """(id, host, path, rule, verdict, p_block) of each row.

    A null url, or one without ``://``, has an empty host and path, which fit no rule. Repeated
    rows come out repeated.
    """
    rows = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    model = model.copy().setFeaturesCol("features").setRawPredictionCol("raw").setProbabilityCol("p").setPredictionCol("guess")
    scored = model.transform(_features(rows, "host", "path", "features"))
    p = vector_to_array("p")[1]
    return scored.select(F.col("id").alias(id_col), "host", "path", name.alias("rule"),
                         F.coalesce(verdict, F.when(p >= 0.5, "block").otherwise("allow")).alias("verdict"), p.alias("p_block"))
