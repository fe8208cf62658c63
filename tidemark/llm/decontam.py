"""Operator 8, benchmark decontamination by template canonicalisation, with DataFrame functions only.

A text becomes tokens (numbers with their decimals, runs of letters, single letters of scripts that put no blanks
between words). A number, in digits or as a word, a capitalised word (a name, or the start
of a sentence) and a unit after a number become typed placeholders; other words are lower-cased. Windows of WIDTH such
tokens are hashed and joined with the benchmark's windows, so a question with other numbers, names or units still
matches. As the placeholder of a name depends on the text's case, each window is hashed in two more forms without case:
with placeholders for numbers and units alone, and word for word. So a copy in capitals or in lower case matches as well,
but for those of its windows in which a name was changed too. A window whose slots have
the benchmark's own values counts always. In any other the values must correspond: the same name or unit became the same
other one and two never became one, and the same number the same other number, which separates a re-parameterised
question from a mere likeness of form. The verdict is each window's own, so a clash costs only the windows that hold it.
An item is found in a text if such windows cover MIN_COVER of its own, or if an unbroken run of them holds RUN tokens
that are the benchmark's own, however long the item is.

An item of fewer than MIN_TOKENS tokens has no form that tells it from ordinary speech. It is found where it stands by
itself, word for word but for case: as the whole text, a line, a sentence, or between quotes or brackets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import is_small, keys_hint, stage, unstage

#: Tokens of a window; literal words that a window needs outside the literal form; tokens below which an item must stand by itself; share of an item's windows;
#: or else tokens of an unbroken run of windows that stand word for word in the text.
WIDTH, MIN_LITERAL, MIN_TOKENS, MIN_COVER, RUN = 8, 3, 4, 0.3, 13
#: Benchmark windows (some 50 bytes each) up to which they are broadcast; beyond, the join is shuffled.
BROADCAST_ROWS = 500_000
#: Words that are a unit when they follow a number.
UNITS = (
    "mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers mg g kg lb lbs oz gram grams "
    "kilogram kilograms pound pounds ounce ounces ton tons ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour "
    "hours day days week weeks month months year years k c f degree degrees percent dollar dollars euro euros cent cents mph kmh watt watts volt volts"
).split()
#: Words that are a number. Those that are articles as well are left out.
NUMBER_WORDS = (
    "two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty "
    "sixty seventy eighty ninety hundred thousand million billion zwei drei vier fünf sechs sieben acht neun zehn elf zwölf zwanzig dreißig hundert tausend "
    "deux trois quatre cinq sept huit neuf dix onze douze quinze vingt trente cent mille dos tres cuatro cinco seis siete ocho nueve diez once doce veinte treinta cien mil"
).split()
#: What a window is hashed by: with placeholders; with those for numbers and units alone; by its words and numbers.
FORMS = ("template", "caseless", "literal")
#: Code points of scripts that put no blanks between words (Thai and Lao, Burmese, Khmer, Japanese and Chinese),
#: each of whose letters is a token. Ranges, since Java looks a script up by a search for each character.
NO_BLANKS = r"\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\x{20000}-\x{3FFFF}"
TOKEN = rf"[0-9]+(?:[.,][0-9]+)*|[\p{{L}}\p{{M}}&&[^{NO_BLANKS}]]+|[{NO_BLANKS}]"
#: What stands for a slot of each kind, besides 0, a plain word.
NUMBER, UNIT, NAME = 1, 2, 3


def tokens_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), 0)


def is_number(token: Column) -> Column:
    return token < ":"  # tokens start with a digit or a letter


def is_counted(token: Column) -> Column:
    """Whether a folded token is a number, in digits or as a word."""
    return is_number(token) | token.isin(*[w.upper().lower() for w in NUMBER_WORDS])  # folded as texts are


def fold(text: Column) -> Column:
    """A text without its case; by way of upper case, which joins letters (ß and ss, final sigma) that lower case parts.
    Letters become letters and marks, so the text keeps its number of tokens. Spark would take lower(upper(x)) for
    lower(x), hence the concat."""
    return F.lower(F.concat(F.upper(text), F.lit("")))


def with_shapes(df: DataFrame, text: Column) -> DataFrame:
    """df with words array<string> (tokens without case), kind array<int> (of each token: NUMBER, UNIT after a number, NAME
    or 0) and one array<long> of hashes for each form. Case is folded for the whole text at once, not for each token."""
    text = F.coalesce(text, F.lit(""))
    df = df.withColumns({"words": tokens_of(fold(text)), "capital": F.zip_with(tokens_of(text), tokens_of(F.lower(text)), lambda t, low: t != low)})
    after_number = lambda i: F.coalesce(is_counted(F.get("words", i - 1)), F.lit(False))
    df = df.withColumn("kind", F.transform("words", lambda w, i: F.when(is_counted(w), NUMBER).when(after_number(i) & w.isin(*UNITS), UNIT).otherwise(0)))
    # not by the place in that function: Spark would put the whole making of `capital` there, for each token
    df = df.withColumn("kind", F.zip_with("kind", "capital", lambda k, c: F.when((k == 0) & c, NAME).otherwise(k)))
    df = df.withColumn("literal", F.transform("words", lambda w: F.xxhash64(w)))
    fixed = lambda k, h: F.when(k == 0, h).when(k == NUMBER, F.xxhash64(F.lit("#number"))).when(k == UNIT, F.xxhash64(F.lit("#unit")))
    return df.withColumns({
        "template": F.zip_with("kind", "literal", lambda k, h: fixed(k, h).otherwise(F.xxhash64(F.lit("#name")))),
        "caseless": F.zip_with("kind", "literal", lambda k, h: fixed(k, h).otherwise(h)),
    }).drop("capital")


def with_fours(df: DataFrame) -> DataFrame:
    """df with each form's hashes of single tokens made into hashes of four; the last three of a text stand for fewer."""
    for span in (1, 2):
        df = df.withColumns({f: F.zip_with(f, F.slice(f, span + 1, F.size(f)), lambda a, b: F.xxhash64(a, b)) for f in FORMS})
    return df


def windows_of(width: int) -> Column:
    """For each window of `width` tokens (MIN_TOKENS = 4 to 8): its hash in each form, made of those of its first and last four."""
    count = F.greatest(F.size("words") - width + 1, F.lit(0))
    one = lambda f: F.slice(F.zip_with(f, F.slice(f, width - 3, F.size(f)), lambda a, b: F.xxhash64(a, b, F.lit(width))), F.lit(1), count).alias(f)
    return F.arrays_zip(*[one(f) for f in FORMS])


def benchmark_windows(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, of, of_template, width, at, hash, words, slots, plain): every window of every item by the hash of each form
    that it is usable in, with its words, how many windows the item has, and how many usable templates (plain)."""
    items = with_fours(with_shapes(benchmark.select(F.col(id_col).alias("item"), F.col(text_col).alias("text")), F.col("text")))
    items = items.filter((F.size("words") >= MIN_TOKENS) & F.col("item").isNotNull()).withColumn("width", F.least(F.size("words"), F.lit(WIDTH)))
    by_width = F.when(F.col("width") == WIDTH, windows_of(WIDTH))
    for width in range(MIN_TOKENS, WIDTH):
        by_width = by_width.when(F.col("width") == width, windows_of(width))
    out = items.select("item", "width", "words", "kind", F.posexplode(by_width).alias("at", "form"))
    out = out.withColumn("words", F.expr("slice(words, at + 1, width)")).withColumn("kind", F.expr("slice(kind, at + 1, width)"))
    out = out.withColumn("slots", F.transform("kind", lambda k: F.when(k == NUMBER, "number").when(k != 0, "name")))
    enough = lambda plain: F.size(F.filter("kind", plain)) >= F.least(F.lit(MIN_LITERAL), F.col("width") - 1)
    out = out.withColumn("plain", enough(lambda k: k == 0))
    usable = F.array(F.when(F.col("plain"), F.col("form.template")), F.when(enough(lambda k: k.isin(0, NAME)), F.col("form.caseless")), F.col("form.literal"))
    n = out.groupBy("item").agg(F.count_distinct("at").alias("of"), F.count_distinct(F.when(F.col("plain"), F.col("at"))).alias("of_template"))
    out = out.withColumn("hash", F.explode(F.array_distinct(F.array_compact(usable))))
    return out.drop("kind", "form").distinct().join(n, "item")


def fits(pairs: str) -> Column:
    """Whether a window's slots correspond: names and units one to one; a number always became the same number, but two
    may have become equal. Other words must be the same."""
    def one_to(column: str, kind: str) -> Column:
        of = F.filter(pairs, lambda p: p["slots"] == kind)
        distinct = lambda *names: F.size(F.array_distinct(F.transform(of, lambda p: F.struct(*[p[n].alias(n) for n in names]))))
        return distinct("words", "theirs") == distinct(column)

    words = F.forall(pairs, lambda p: p["slots"].isNotNull() | (p["words"] == p["theirs"]))
    return words & one_to("words", "number") & one_to("words", "name") & one_to("theirs", "name")


def longest_run(windows: str) -> Column:
    """The most tokens with the benchmark's own values that one run of consecutive windows (at, first: whether its first
    token has it, same: how many have) holds. The tokens of a run are the first ones of its windows, and the last one's others."""
    step = lambda s, w: F.struct(
        w["at"].alias("at"), w["first"].alias("first"),
        F.when(w["at"] == s["at"] + 1, s["ahead"] + s["first"]).otherwise(0).alias("ahead"),
        F.greatest(s["most"], F.when(w["at"] == s["at"] + 1, s["ahead"] + s["first"]).otherwise(0) + w["same"]).alias("most"))
    start = F.struct(F.lit(-9).alias("at"), F.lit(0).alias("first"), F.lit(0).alias("ahead"), F.lit(0).alias("most"))
    return F.aggregate(F.array_sort(windows), start, step, lambda s: s["most"])


#: Where a stretch of text that stands by itself ends: lines, sentences, quotes, brackets.
STRETCH_END = r"[\n\r\x0B\x0C\u0085\u2028\u2029]+|[.?!:;\u2026]+(?=\s|$)|[\u3002\uFF01\uFF1F]+|[\"\u201C\u201D\u201E\u00AB\u00BB()\[\]{}]"
#: As many tokens in a row as no short item has.
_LONG_STRETCH = rf"(?:(?:{TOKEN.replace(']+', ']++').replace(')*', ')*+')})[^0-9\p{{L}}\p{{M}}]*+){{{MIN_TOKENS}}}"


def short_items(rows: DataFrame, benchmark: DataFrame, item_col: str, item_text_col: str) -> DataFrame | None:
    """found_items for items of 1 to MIN_TOKENS - 1 tokens: those that a stretch of the text equals. None without any."""
    line = lambda text: F.array_join(tokens_of(fold(text)), " ")
    items = benchmark.select(F.col(item_col).alias("item"), F.coalesce(F.col(item_text_col), F.lit("")).alias("t")).filter("item is not null")
    items = stage(items.select("item", line(F.col("t")).alias("line"), F.size(tokens_of(F.col("t"))).alias("n")).filter(f"n between 1 and {MIN_TOKENS - 1}").select("item", "line").distinct(), "short")
    if items.isEmpty():
        return None
    alone = F.filter(F.split("text", STRETCH_END), lambda s: ~s.rlike(_LONG_STRETCH))
    lines = rows.filter("text is not null").select("k1", "k2", F.explode(F.array_distinct(F.transform(alone, line))).alias("line")).filter("line <> ''")
    hint = F.broadcast if is_small(items, BROADCAST_ROWS) else (lambda df: df)
    found = lines.join(hint(items), "line").groupBy("k1", "k2", "item").agg(F.count_distinct("line").cast("int").alias("n_windows"))
    return found.select("k1", "k2", "item", "n_windows", F.lit(1.0).alias("coverage"), F.lit(True).alias("verbatim"))


def found_items(rows: DataFrame, benchmark: DataFrame, item_col: str, item_text_col: str) -> DataFrame:
    """(k1, k2, item, n_windows, coverage, verbatim) for every distinct text of rows (k1, k2, text) that holds an item."""
    bench = stage(benchmark_windows(benchmark, item_col, item_text_col), "bench")
    small = is_small(bench, BROADCAST_ROWS)
    hint = F.broadcast if small else (lambda df: df)
    widths = sorted(r.width for r in bench.select("width").distinct().collect())  # MIN_TOKENS to WIDTH at most
    shaped = with_fours(with_shapes(rows.filter("text is not null").select("k1", "k2", "text"), F.col("text"))).select("k1", "k2", "words", *FORMS)
    found = None
    x, y, z = (F.col(f"form.{f}") for f in FORMS)  # equal ones once
    differing = F.when((x == y) & (y == z), F.array(x)).when(x == y, F.array(x, z)).when(y == z, F.array(x, y)).otherwise(F.array(x, y, z))
    for width in widths or [WIDTH]:
        # outer, since a filter on the array would be pushed down, and there compute the shapes anew for each window
        wide = shaped.select("k1", "k2", F.posexplode_outer(windows_of(width)).alias("pos", "form"))
        wide = wide.select("k1", "k2", "pos", F.explode(differing).alias("hash"))
        hits = wide.join(hint(bench.filter(F.col("width") == width).select("hash", "item", "at").distinct()), "hash").drop("hash")
        found = hits if found is None else found.unionByName(hits)
    found = stage(found.distinct(), "hits")
    marked = stage(found.select("k1", "k2").distinct(), "holders")
    holders = keys_hint(marked)
    texts = rows.join(holders, ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"]).select("k1", "k2", tokens_of(fold(F.col("text"))).alias("tokens"))
    runs = found.groupBy("k1", "k2", "item", (F.col("pos") - F.col("at")).alias("shift")).agg(F.collect_list(F.struct("pos", "at")).alias("hits"))
    slim = runs.join(texts, ["k1", "k2"]).select("k1", "k2", "item", "shift", F.explode("hits").alias("h"), "tokens")
    slim = slim.select("k1", "k2", "item", "shift", F.col("h.at").alias("at"), F.slice("tokens", F.col("h.pos") + 1, F.lit(WIDTH)).alias("theirs"))
    both = slim.join(hint(bench.select("item", "at", "words", "slots", "plain", "of", "of_template").distinct()), ["item", "at"])
    pairs = F.arrays_zip("words", F.expr("slice(theirs, 1, size(words))").alias("theirs"), "slots")
    both = both.select("k1", "k2", "item", "shift", "at", "plain", "of", "of_template", pairs.alias("pairs"))
    shown = both.withColumn("verbatim", F.forall("pairs", lambda p: p["words"] == p["theirs"])).filter(F.col("verbatim") | fits("pairs"))
    own = F.transform("pairs", lambda p: (p["words"] == p["theirs"]).cast("int"))
    window = F.struct("at", F.get(own, F.lit(0)).alias("first"), F.size(F.filter(own, lambda x: x == 1)).alias("same"))
    shown = shown.withColumn("window", window).groupBy("k1", "k2", "item", "shift", "of", "of_template").agg(
        F.collect_set("at").alias("ats"), F.collect_set(F.when(F.col("plain"), F.col("at"))).alias("plain"),
        F.collect_set("window").alias("windows"), F.bool_and("verbatim").alias("verbatim"))
    shown = shown.withColumn("run", longest_run("windows"))
    distinct = lambda c: F.size(F.array_distinct(F.flatten(F.collect_list(c))))
    cover = shown.groupBy("k1", "k2", "item").agg(distinct("ats").alias("n_windows"), distinct("plain").alias("n_template"), F.max("run").alias("run"), F.first("of").alias("of"), F.first("of_template").alias("of_template"), F.bool_and("verbatim").alias("verbatim"))
    share = F.greatest(F.col("n_windows") / F.col("of"), F.when(F.col("of_template") > 0, F.col("n_template") / F.col("of_template")))
    cover = cover.withColumn("coverage", share).filter((F.col("coverage") >= MIN_COVER) | (F.col("run") >= RUN))
    cover = cover.select("k1", "k2", "item", "n_windows", "coverage", "verbatim")
    short = short_items(rows, benchmark, item_col, item_text_col)
    if short is not None:  # texts of one id may be of both kinds
        cover = cover.unionByName(short).groupBy("k1", "k2", "item").agg(F.sum("n_windows").cast("int").alias("n_windows"), F.max("coverage").alias("coverage"), F.bool_and("verbatim").alias("verbatim"))
    out = stage(cover, "cover")
    unstage(bench, found, marked)
    return out


def keyed(text: Column) -> tuple[Column, Column]:
    """Two hashes of a text, 96 bits in all, which stand for it in joins."""
    return F.xxhash64(text).alias("k1"), F.hash(text).alias("k2")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The benchmark items that each text holds, word for word or re-parameterised.

    Returns one row per row of docs and item found in it: id_col, item_col, n_windows long (distinct windows of the item
    found), coverage double (their share of the item's windows, or of those with a usable template if that is more), verbatim
    boolean (all slots of the matches have the benchmark's own values, their case aside).

    Null and empty texts hold nothing; null ids are returned as null. Items without id or without a token are not looked
    for; items shorter than a window are one window, and those of fewer than MIN_TOKENS tokens must stand by themselves. Items with equal id count together. Repeated
    rows of docs give repeated rows of the result. Other columns are ignored, whatever their names. Empty tables give an
    empty table.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *keyed(F.col(text_col)))
    cover = found_items(rows, benchmark, item_col, item_text_col)
    out = rows.select("id", "k1", "k2").join(cover, ["k1", "k2"])
    return out.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "n_windows", "coverage", "verbatim")


def without_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """docs without the rows whose text holds a benchmark item; rows are told by their text, so ids do not matter."""
    k1, k2 = keyed(F.col(text_col))
    rows = docs.select(F.col(text_col).alias("text"), k1, k2)
    bad = found_items(rows, benchmark, item_col, item_text_col).select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2")).distinct()
    return docs.join(bad, (F.xxhash64(text_col) == bad["_k1"]) & (F.hash(text_col) == bad["_k2"]), "left_anti")
