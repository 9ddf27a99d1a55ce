"""URL filter by association rules (operator 3), in DataFrame functions only.

Explicit (host, path) rules decide the urls they fit.  They are no evidence
about other urls: which urls they select would only be learned again.  The
labelled examples are pages whose article shares most of its words with rated
documents.  Tokens with enough support and confidence for ``block`` are rules
by themselves, and nothing is added to them.  The others are combined: all
combinations that are confident, without a smaller confident part, become
rules too.  They are mined size by size, and only what may still become such a
rule is grown, so that a long url does not list all its combinations.  Rules
are matched to all tokens of the remaining urls through an inverted index from
token to rule.  A url that no rule blocks is allowed.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countwise.llm.frames import WORD_SPLIT, stored

MIN_SUPPORT = 0.01
MIN_CONFIDENCE = 0.9
#: Least words of a run that a page and a document share, and the least share of
#: an article's words within such runs (in percent) that labels the page.
WINDOW = 8
MIN_SHARED = 50
#: Rated documents that are broadcast, at about 16 bytes; more are joined by a shuffle.
BROADCAST_RATED = 1 << 20
#: Words per passage, about.
CUT = 8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def split_url() -> tuple[Column, Column]:
    """(host, path) of the column ``url_``: both empty for null or without ``://``."""
    rest = F.expr("substring(url_, instr(url_, '://') + 3)")
    has = F.coalesce(F.instr(F.col("url_"), "://") > 0, F.lit(False))
    host = F.when(has, F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)).otherwise("")
    path = F.when(has, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise("")
    return host, path


def url_tokens(url: str = "url", host: str = "host", path: str = "path") -> Column:
    """Distinct tokens of a url: host labels, path words (digits alike), parameter names, fragment."""
    labels = F.transform(F.split(F.col(host), r"\."), lambda x: F.concat(F.lit("host:"), x))
    words = F.transform(F.split(F.regexp_replace(F.col(path), "[0-9]+", "#"), "/"), lambda x: F.concat(F.lit("path:"), x))
    query = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"\?([^#]*)", 1)
    names = F.transform(F.split(query, "&"), lambda x: F.concat(F.lit("name:"), F.substring_index(x, "=", 1)))
    mark = F.when(F.instr(F.coalesce(F.col(url), F.lit("")), "#") > 0, F.array(F.lit("mark:#"))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.filter(F.concat(labels, words, names, mark), lambda x: ~x.isin("host:", "path:", "name:")))


def explicit_rule(rules: list[UrlRule]) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits, else nulls; ``rules`` is a short list of the caller."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.text)):
        fits = ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path)
        text, verdict = F.when(fits, F.lit(r.text)).otherwise(text), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return text, verdict


def article_text(html: Column) -> Column:
    """The text of the page's ``<article>`` parts, or of the whole page without any: tags are blanks."""
    parts = F.regexp_extract_all(html, F.lit(r"(?is)<article\b[^>]*>(.*?)</article>"), F.lit(1))
    text = F.when(F.size(parts) > 0, F.array_join(parts, " ")).otherwise(html)
    text = F.regexp_replace(text, r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>|<[^>]*>", " ")
    for mark, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        text = F.replace(text, F.lit(mark), F.lit(sign))
    return text


def _begins(word: Column) -> Column:
    return (31 * F.ascii(word) + F.char_length(word)) % CUT == 0


def _passages(text: Column) -> Column:
    """(number of words, passages (hash, number of words)) of a text.

    A passage begins at the first word and at every word whose own first
    character and length say so (about one in ``CUT``), so equal runs are cut
    alike wherever they stand, and the passages hold every word once.  Its hash
    covers the ``WINDOW`` - 1 words behind it too.
    """
    words = F.filter(F.split(F.coalesce(text, F.lit("")), WORD_SPLIT), lambda w: w != "")

    def cut(w: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(1), F.size(w)), lambda i: (i == 1) | _begins(F.get(w, i - 1)))
        ends = F.concat(F.slice(starts, 2, F.size(w)), F.array(F.size(w) + 1))
        return F.zip_with(starts, ends, lambda i, j: F.struct(
            F.xxhash64(j - i, F.slice(w, i, j - i + (WINDOW - 1))).alias("h"), (j - i).alias("words")))

    # A lambda's argument is computed once; a column could be computed again at every step.
    return F.get(F.transform(F.array(words), lambda w: F.struct(
        F.size(w).alias("n"), F.when(F.size(w) > 0, cut(w)).alias("passages"))), 0)


def page_evidence(pages: DataFrame, documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(url, blocked) of the pages that ``labels`` says something about.

    The passages of the pages (url, html) meet those of the rated documents
    (doc_id, text).  A page has a label if met passages hold at least
    ``MIN_SHARED`` percent of its article's words; it is blocked if most of
    them, each by the share of its documents, come from documents of quality 0
    or toxic ones; a document that is rated several times counts as such if one
    rating says so.  Fully equal pages are one example.
    """
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when((F.col("quality") == 1) | (F.col("toxic") == 0), 0)
    rated = labels.select("doc_id", bad.alias("bad")).filter("doc_id IS NOT NULL AND bad IS NOT NULL")
    rated = stored(rated.groupBy("doc_id").agg(F.max("bad").alias("bad")), "url-rated")
    if rated.count() <= BROADCAST_RATED:
        hashes = documents.select("doc_id", "text").join(F.broadcast(rated), "doc_id").select(_passages(F.col("text"))["passages"]["h"].alias("hashes"), "bad")
    else:  # passages are smaller than texts
        hashes = documents.select("doc_id", _passages(F.col("text"))["passages"]["h"].alias("hashes")).join(rated, "doc_id")
    known = hashes.filter("hashes IS NOT NULL").select(F.explode("hashes").alias("h"), "bad").groupBy("h").agg(F.avg("bad").alias("bad"))
    key = [F.xxhash64("url", "html").alias("k1"), F.xxhash64(F.lit("page"), "html", "url").alias("k2")]
    own = pages.filter("url IS NOT NULL").select(*key, _passages(article_text(F.col("html"))).alias("p"))
    own = own.select("k1", "k2", F.col("p.n").alias("n"), F.posexplode("p.passages").alias("place", "passage")).select(
        "k1", "k2", "n", "place", "passage.*")
    met = own.join(known, "h").groupBy("k1", "k2", "n").agg(
        F.collect_set(F.struct("place", "words")).alias("met"), F.avg("bad").alias("bad"))
    shared = F.aggregate("met", F.lit(0), lambda n, x: n + x["words"])
    found = met.filter(100 * shared >= MIN_SHARED * F.col("n")).select("k1", "k2", (F.col("bad") > 0.5).alias("blocked"))
    return pages.filter("url IS NOT NULL").select("url", *key).distinct().join(found, ["k1", "k2"]).select("url", "blocked")


def undecided_share(judged: DataFrame) -> DataFrame:
    """One row (n_undecided, n_blocked, share) about the pages that no explicit rule decides."""
    rest = judged.filter("rule IS NULL")
    return rest.agg(F.count("*").alias("n_undecided"), F.count_if(F.col("verdict") == "block").alias("n_blocked"),
                    F.avg((F.col("verdict") == "block").cast("int")).alias("share"))


def _containing(rows: DataFrame, rules: DataFrame, *row: str) -> DataFrame:
    """(columns ``row``, rule_id) of the rows (.., token) that hold all tokens of a rule (rule_id, tokens)."""
    index = rules.select("rule_id", F.size("tokens").alias("n"), F.explode("tokens").alias("token"))
    return rows.join(index, "token").groupBy(*row, "rule_id", "n").count().filter(F.col("count") == F.col("n")).select(*row, "rule_id")


def _parts(items: Column) -> Column:
    """The sets of one item less."""
    return F.transform(F.sequence(F.lit(1), F.size(items)), lambda i: F.concat(
        F.slice(items, 1, i - 1), F.slice(items, i + 1, F.size(items))))


def _confident_sets(baskets: DataFrame, singles: DataFrame, least: int, min_confidence: float) -> DataFrame:
    """(items, b, u): every minimal confident set of two or more items, and perhaps some that hold a smaller one.

    ``baskets`` (items ascending, b, u) tells how many blocked and other
    examples have just these items, ``singles`` (item, b, u) how many have the
    item; none of them is confident by itself.  Sets grow by one item a round,
    in ascending order.  None is lost by what is not grown, since a minimal set
    stays clear of it:

    * sets in fewer than ``least`` blocked examples;
    * confident sets, and those with an item that keeps out no unblocked example
      that the others let in: without it they are as confident or more;
    * sets (``head``) that are not confident even with the unblocked examples
      that hold all items (``n_tail``) by which they may still grow.
    """
    confident = F.col("b") / (F.col("b") + F.col("u")) >= min_confidence
    sums = F.sum("b").alias("b"), F.sum("u").alias("u")
    known = singles.select(F.array("item").alias("items"), "b", "u", F.lit(True).alias("open"))
    # What is left of the baskets that hold all of ``head``.
    rest = baskets.select("items", "b", "u", F.posexplode("items").alias("p", "item")).select(
        F.array("item").alias("head"), F.slice("items", F.col("p") + 2, F.size("items")).alias("rest"), "b", "u").filter(F.size("rest") > 0)
    rest = stored(rest.groupBy("head", "rest").agg(*sums), "url-rest")
    found = known.filter("NOT open").select("items", "b", "u")
    while not rest.isEmpty():
        grown = rest.select("head", F.explode("rest").alias("last"), "b", "u").groupBy("head", "last").agg(*sums).filter(F.col("b") >= least)
        grown = grown.select(F.concat("head", F.array("last")).alias("items"), "b", "u")
        part = known.select(F.col("items").alias("part"), F.col("u").alias("part_u"), "open")
        idle = grown.select("items", "u", F.explode(_parts(F.col("items"))).alias("part")).join(part, "part").filter(
            ~F.col("open") | (F.col("part_u") <= F.col("u"))).select("items").distinct().withColumn("idle", F.lit(True))
        grown = grown.join(idle, "items", "left").select("items", "b", "u", F.col("idle").isNull().alias("useful"), confident.alias("confident"))
        grown = stored(grown, "url-sets")
        found = found.union(grown.filter("useful AND confident").select("items", "b", "u"))
        known = grown.select("items", "b", "u", F.expr("useful AND NOT confident").alias("open"))

        tails = known.filter("open").select(F.slice("items", 1, F.size("items") - 1).alias("head"), F.struct(F.element_at("items", -1).alias("item"), "b").alias("x"))
        tails = tails.groupBy("head").agg(F.sort_array(F.collect_list("x")).alias("tail"))
        # A tail's own items are in the order of the baskets' items.
        left = rest.join(tails, "head").select("head", "tail", F.array_intersect("rest", "tail.item").alias("rest"), "b", "u")
        left = left.select("*", F.posexplode("rest").alias("p", "item")).withColumn("at", F.array_position("tail.item", F.col("item")).cast("int"))
        left = left.select(
            F.concat("head", F.array("item")).alias("head"), F.slice("rest", F.col("p") + 2, F.size("rest")).alias("rest"), "b", "u",
            (F.size("tail") - F.col("at")).alias("n_tail"), F.element_at("tail", F.col("at"))["b"].alias("top")).filter(F.size("rest") > 0)
        left = stored(left.groupBy("head", "rest", "n_tail", "top").agg(*sums), "url-rest")
        most = F.col("top") / (F.col("top") + F.sum(F.when(F.size("rest") == F.col("n_tail"), F.col("u")).otherwise(0)))
        hopeful = left.groupBy("head", "top").agg(most.alias("most")).filter(F.col("most") >= min_confidence)
        rest = left.join(hopeful.select("head"), "head", "left_semi").select("head", "rest", "b", "u")
    return found


def _minimal(sets: DataFrame) -> DataFrame:
    """The sets (items ascending, at least two) that hold no smaller one.

    A smaller one is looked up by its first two items among all pairs of a set.
    """
    small = sets.select(F.slice("items", 1, 2).alias("pair"), F.col("items").alias("small"))
    pairs = F.flatten(F.transform("items", lambda x, i: F.transform(
        F.slice("items", i + 2, F.size("items")), lambda y: F.array(x, y))))
    larger = sets.filter(F.size("items") > 2).select("items", F.explode(pairs).alias("pair")).join(small, "pair").filter(
        (F.size("small") < F.size("items")) & (F.size(F.array_except("small", "items")) == 0)).select("items").distinct()
    return sets.join(larger, "items", "left_anti")


def mine_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Learned rules (rule_id, tokens, confidence) from (tokens, blocked).

    All sets of tokens that are in enough blocked examples and confident, and
    that hold no smaller such set; all are counted in all examples.
    """
    rows = stored(labelled.select(F.monotonically_increasing_id().alias("id"), F.array_distinct("tokens").alias("tokens"), "blocked"), "url-evidence")
    least = max(1, math.ceil(min_support * rows.count()))
    share = (F.col("b") / F.col("n")).alias("confidence")

    each = rows.select("id", "blocked", F.explode("tokens").alias("token"))
    common = each.groupBy("token").agg(F.count("*").alias("n"), F.count_if("blocked").alias("b")).filter(F.col("b") >= least).select("token", "b", "n", share)
    # Items are numbered from the most telling token on.
    common = stored(common.orderBy(F.desc("confidence"), F.desc("b"), "token").withColumn("item", F.monotonically_increasing_id()), "url-tokens")
    single = common.filter(F.col("confidence") >= min_confidence).select(F.array("token").alias("tokens"), "confidence")
    other = common.filter(F.col("confidence") < min_confidence).select("token", "item", "b", (F.col("n") - F.col("b")).alias("u"))
    told = each.join(other.select("token", "item"), "token").groupBy("id", "blocked").agg(F.sort_array(F.collect_list("item")).alias("items"))
    blocked = F.count_if("blocked")
    baskets = told.groupBy("items").agg(blocked.alias("b"), (F.count("*") - blocked).alias("u"))
    sets = stored(_confident_sets(baskets, other.select("item", "b", "u"), least, min_confidence), "url-rules")
    named = _minimal(sets).select("items", (F.col("b") / (F.col("b") + F.col("u"))).alias("confidence"), F.explode("items").alias("item")).join(other, "item")
    named = named.groupBy("items", "confidence").agg(F.sort_array(F.collect_list("token")).alias("tokens")).select("tokens", "confidence")
    return named.union(single).select(F.xxhash64("tokens").alias("rule_id"), "tokens", "confidence")


def judge_urls(pages: DataFrame, rules: list[UrlRule], min_support: float = MIN_SUPPORT,
               min_confidence: float = MIN_CONFIDENCE, evidence: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, n_learned for every row of ``pages`` (page_id, url).

    A null url, or one without ``://``, has empty host and path, fits no rule
    and is allowed.  Repeated rows and null ids each keep their row.  Rules are
    learned from ``evidence`` (url, blocked), see ``page_evidence``; without it,
    or without blocked urls in it, nothing is learned.  Other columns are
    ignored.
    """
    host, path = split_url()
    rows = pages.select("page_id", F.col("url").alias("url_"))
    rows = rows.select("page_id", "url_", host.alias("host"), path.alias("path"))
    text, verdict = explicit_rule(rules)
    rows = rows.withColumns({"rule": text, "explicit": verdict, "tokens": url_tokens("url_")})
    if evidence is None:
        return rows.select("page_id", "host", "path", "rule", F.coalesce("explicit", F.lit("allow")).alias("verdict"), F.lit(0).cast("bigint").alias("n_learned"))
    labelled = evidence.select(F.col("url").alias("url_"), "blocked").select("url_", "blocked", host.alias("host"), path.alias("path"))
    learned = mine_rules(labelled.select(url_tokens("url_").alias("tokens"), "blocked"), min_support, min_confidence)
    open_rows = rows.filter(F.col("explicit").isNull()).select("page_id", "url_", F.explode("tokens").alias("token")).distinct()
    hits = _containing(open_rows, learned, "page_id", "url_").groupBy(
        F.col("page_id").alias("hit_page"), F.col("url_").alias("hit_url")).agg(F.count("*").alias("n_learned"))
    return rows.join(hits, F.col("page_id").eqNullSafe(F.col("hit_page")) & (F.col("url_") == F.col("hit_url")), "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("explicit", F.when(F.col("n_learned") > 0, "block").otherwise("allow")).alias("verdict"),
        F.coalesce(F.when(F.col("explicit").isNull(), F.col("n_learned")), F.lit(0).cast("bigint")).alias("n_learned"))
