"""Posts and news: tag, clean, de-duplicate, score, and roll up per ticker."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymart.functions.numbers import combined_mean, mean_of_micros, micros, round_half_up
from daymart.functions.text import clean_text, compound, one_line, post_label, ticker_label, tokens, valence_sum
from daymart.operators.pick import first_n, keep_first, newest_n
from daymart.sources.day_tables import on_day

# Search word of a post -> ticker it is filed under.
TICKER_OF_KEYWORD = {
    "Sembcorp": "U96",
    "Ascendas": "A17U",
    "Capitaland": "C38U",
    "City Developments Limited": "C09",
    "Comfortdelgro": "C52",
    "Dairy Farm International Holdings": "D01",
    "DBS": "D05",
    "Frasers Centrepoint": "BUOU",
    "Genting Singapore": "G13",
    "Hongkong Land Holdings": "H78",
    "Jardine": "C07",
    "Jardine Matheson": "J36",
    "Keppel Corp": "BN4",
    "Keppel DC REIT": "AJBU",
    "Mapletree Commercial Trust": "N2IU",
    "Mapletree Industrial Trust": "ME8U",
    "Mapletree Logistics Trust": "M44U",
    "OCBC": "O39",
    "Sats Ltd": "S58",
    "SGX": "S68",
    "Singapore Airlines": "C6L",
    "Singtel": "Z74",
    "ST Engineering": "S63",
    "Thai Beverage PCL": "Y92",
    "UOB": "U11",
    "UOL": "U14",
    "Venture Corp": "V03",
    "Wilmar": "F34",
    "Yangzijiang Shipbuilding": "BS6",
}

# How stored posts name where they came from.
KEYWORD_SOURCE = "Twitter seachword: "
FORUM_SOURCE = "Reddit: "
HASHTAG_SOURCE = "Twitter: #SGX"

# A mapping travels inside the plan, a table (``token, valence``) is joined; the scores are the same.
Lexicon = DataFrame | Mapping[str, float | None]


def tag_by_keyword(posts: DataFrame, keyword: str) -> DataFrame:
    """Append ``ticker`` and ``source`` from the search word that found the post."""
    pairs = [c for pair in TICKER_OF_KEYWORD.items() for c in map(F.lit, pair)]
    ticker = F.try_element_at(F.create_map(*pairs), F.col(keyword))
    return posts.withColumns({"ticker": ticker, "source": F.concat(F.lit(KEYWORD_SOURCE), F.col(keyword))})


def newest_per_keyword(posts: DataFrame, keys: list[str], stamp: str, tie: str, n: int) -> DataFrame:
    """The newest ``n`` posts per key, as a search returns them."""
    return first_n(posts, keys, [F.col(stamp).desc(), F.col(tie)], n)


def newest_per_forum(posts: DataFrame, forum: str, stamp: str, tie: str, n: int) -> DataFrame:
    """At most ``n`` posts per forum, the newest first."""
    return newest_n(posts, [forum], stamp, tie, n)


def union_sources(*parts: DataFrame) -> DataFrame:
    """Posts of several sources; an absent column or an empty source is no obstacle."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


# The columns on which two texts of a kind count as the same.
SAME_SOCIAL = ["content", "ticker", "p_date"]
SAME_NEWS = ["title", "ticker"]
SAME_FORUM = ["title", "p_date"]


def first_posts(posts: DataFrame, same: Sequence[str], order: Sequence[str], of: Column) -> DataFrame:
    """The first of equal rows among those with ``of``; all others stay, each for itself, so they meet nowhere."""
    alone = F.when(~of, F.monotonically_increasing_id())
    return keep_first(posts.withColumn("_alone", alone), [*same, "_alone"], order).drop("_alone")


def clean_social(posts: DataFrame) -> DataFrame:
    """Post texts cleaned, and line breaks turned into spaces in every string."""
    return posts.withColumns(
        {
            "content": one_line(clean_text(F.col("content"))),
            "ticker": one_line(F.col("ticker")),
            "source": one_line(F.col("source")),
        }
    )


def clean_news(news: DataFrame) -> DataFrame:
    return news.withColumns({c: clean_text(F.col(c)) for c in ("title", "description")})


def clean_forum(posts: DataFrame) -> DataFrame:
    return posts.withColumn("title", clean_text(F.col("title")))


def social_table(posts: DataFrame, seq: str) -> DataFrame:
    """Cleaned posts, the first of equal ones in ``seq`` order."""
    first = keep_first(clean_social(posts), SAME_SOCIAL, [seq])
    return first.select("p_date", "ticker", "source", "content", seq)


def news_table(news: DataFrame, *order: str) -> DataFrame:
    """Cleaned news, the first of equal ones in the given order."""
    return keep_first(clean_news(news), SAME_NEWS, order)


def forum_table(posts: DataFrame, *order: str) -> DataFrame:
    """Cleaned posts, the first of equal ones in the given order."""
    return keep_first(clean_forum(posts), SAME_FORUM, order).select("source", "title", "p_date", *order)


def lexicon_weights(lexicon: DataFrame) -> DataFrame:
    """``token`` and its valence in whole thousandths: one row per token, those without a valence left out.

    A token that is listed twice fails the job, because neither of its valences is the right one.
    """
    thousandths = F.round(F.col("valence").cast("decimal(28,12)"), 3) * 1000
    listed = lexicon.where(F.col("token").isNotNull() & F.col("valence").isNotNull()).select(
        "token", thousandths.cast("bigint").alias("_w")
    )
    repeated = F.raise_error(F.concat(F.lit("token listed twice: "), F.col("token"))).cast("bigint")
    return (
        listed.groupBy("token")
        .agg(F.count("*").alias("_n"), F.min("_w").alias("_w"))
        .select("token", F.when(F.col("_n") > 1, repeated).otherwise(F.col("_w")).alias("_w"))
    )


def score_posts(
    posts: DataFrame, text: str, lexicon: Lexicon, score: str = "NLTK_score", label: str = "NLTK_sentiment"
) -> DataFrame:
    """Append the compound lexicon score of ``text`` and its label.

    The caller decides how the lexicon travels: a mapping becomes part of the expression and every text is scored
    where it lies; a table is joined to the tokens, and sums travel by the digest of a text.
    """
    if not isinstance(lexicon, DataFrame):
        scored = posts.withColumn(score, compound(valence_sum(text, lexicon)))
    else:
        keyed = posts.withColumn("_key", _digest(text))
        scored = _with_joined_score(keyed, _sums_by_join(keyed, text, lexicon), score).drop("_key")
    return scored.withColumn(label, post_label(F.col(score)))


def scored_posts(
    cleaned: DataFrame,
    text: str,
    same: list[str],
    seq: str,
    lexicon: Lexicon,
    score: str = "NLTK_score",
    label: str = "NLTK_sentiment",
    texts: tuple[str, ...] = ("content", "title", "description"),
) -> DataFrame:
    """Scores of the first of equal posts, for reports that do not show the texts.

    ``same`` names the columns on which two posts count as equal; the columns ``texts`` are left out of the result.
    Equal texts score alike: by a mapping they are scored first, where the texts lie, by a table after the copies are gone.
    Either way digests, sums and scores are shuffled, and no text is.
    """
    shown = [c for c in cleaned.columns if c not in texts]
    if not isinstance(lexicon, DataFrame):
        scored = cleaned.withColumns({score: compound(valence_sum(text, lexicon)), "_same": _digest(*same)})
        scored = keep_first(scored.select(*shown, score, "_same"), ["_same"], [seq])
    else:
        keyed = cleaned.withColumns({"_key": _digest(text), "_same": _digest(*same)})
        first = keep_first(keyed.select(*shown, "_key", "_same"), ["_same"], [seq])
        scored = _with_joined_score(first, _sums_by_join(keyed, text, lexicon), score).drop("_key")
    return scored.withColumn(label, post_label(F.col(score))).drop("_same")


def _digest(*columns: str) -> Column:
    """32 bytes that are the same for equal values of the columns; a missing value equals another missing one only.

    Never NULL: the filter for keys that Spark would infer below a join would clean and digest every text once more.
    """
    each = [F.coalesce(F.sha2(F.col(c).cast("string"), 256), F.lit("-")) for c in columns]
    return F.coalesce(F.unhex(F.sha2(F.concat_ws(",", *each), 256)), F.lit(b""))


def _sums_by_join(keyed: DataFrame, text: str, lexicon: DataFrame) -> DataFrame:
    """``_key`` and the exact sum of valences in thousandths of the text with that digest.

    The lexicon meets the tokens first, so that with a lexicon small enough to be broadcast nothing is shuffled for a token, but one
    row for each text and task.  Tokens are summed over all copies of a text, and the copies counted by their first tokens; each
    copy adds the same, so the quotient is whole.  No text is shuffled.
    """
    placed = keyed.select("_key", F.posexplode(tokens(F.col(text))).alias("_place", "token"))
    copies = F.count(F.when(F.col("_place") == 0, 1)).alias("_copies")
    total = F.coalesce(F.sum("_w"), F.lit(0)).alias("_total")
    sums = placed.join(lexicon_weights(lexicon), "token", "left").groupBy("_key").agg(total, copies)
    return sums.select("_key", F.expr("_total div _copies").alias("_sum"))


def _with_joined_score(keyed: DataFrame, sums: DataFrame, score: str) -> DataFrame:
    return keyed.join(sums, "_key", "left").withColumn(score, compound(F.col("_sum") / F.lit(1000.0))).drop("_sum")


def _means(scored: DataFrame, keys: list[str], score: str, name: str) -> DataFrame:
    exact = micros(F.col(score))
    return (
        scored.groupBy(*keys)
        .agg(F.sum(exact).alias("_s"), F.count(exact).alias("_n"))
        .select(*keys, mean_of_micros(F.col("_s"), F.col("_n")).alias(name))
    )


def _rollup_columns(joined: DataFrame) -> DataFrame:
    combined = combined_mean(F.col("_social"), F.col("_news"))
    return joined.select(
        "p_date",
        "ticker",
        round_half_up(F.col("_social"), 5).alias("avg_twitter_score_ticker"),
        round_half_up(F.col("_news"), 5).alias("avg_news_score_ticker"),
        combined.alias("combined_sentiment_score_ticker"),
        round_half_up(F.col("_market"), 5).alias("benchmark_score_for_today_market"),
        "company_name",
        ticker_label(combined).alias("overall_sentiment_for_ticker"),
    )


def _listing(master: DataFrame) -> DataFrame:
    return master.select("p_date", F.col("stock_code").alias("ticker"), "company_name")


def sentiment_rollup(
    social: DataFrame, news: DataFrame, forum: DataFrame, master: DataFrame, ds: dt.date | None = None
) -> DataFrame:
    """Average scores per day and ticker, with the forum's average as the market benchmark.

    The report is defined over all combinations of a day's social, news and forum rows.  In
    a (day, ticker) group every row of one source is repeated equally often, so averages of
    each source alone are the same; they are taken first and only the averages are joined.
    By that definition a day without forum posts, a ticker without social posts, and a
    ticker absent from the master list give no row.
    """
    social, news, forum, master = (on_day(t, ds) for t in (social, news, forum, master))
    by_ticker = ["p_date", "ticker"]
    joined = (
        _means(social, by_ticker, "NLTK_score", "_social")
        .join(_means(news, by_ticker, "NLTK_score", "_news"), by_ticker, "left")
        .join(_means(forum, ["p_date"], "NLTK_SIA_compound_score", "_market"), "p_date")
        .join(_listing(master), by_ticker)
    )
    return _rollup_columns(joined)


def sentiment_rollup_intent(
    social: DataFrame, news: DataFrame, forum: DataFrame, master: DataFrame, ds: dt.date | None = None
) -> DataFrame:
    """The same report with a row for every ticker that has social posts or news, whether or
    not there are forum posts that day or a master entry."""
    social, news, forum, master = (on_day(t, ds) for t in (social, news, forum, master))
    by_ticker = ["p_date", "ticker"]
    joined = (
        _means(social, by_ticker, "NLTK_score", "_social")
        .join(_means(news, by_ticker, "NLTK_score", "_news"), by_ticker, "full")
        .join(_means(forum, ["p_date"], "NLTK_SIA_compound_score", "_market"), "p_date", "left")
        .join(_listing(master), by_ticker, "left")
    )
    return _rollup_columns(joined)
