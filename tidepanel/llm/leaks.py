"""Benchmark leaks by templates: numbers, names and units become placeholders, windows of templates are joined, and
what stood in the placeholders must correspond. DataFrame expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.llm.common import written
from tidepanel.llm.neardup import only

#: Tokens of a window; an item with fewer tokens is one window.
TOKENS = 8
#: Tokens of a window that must be literal, lest templates of placeholders alone meet.
LITERAL = 4
#: Share of an item's windows that must be found in one place, and the number that is enough for long items.
SHARE, ENOUGH = 0.5, 40
#: Up to so many distinct windows of the benchmark are broadcast to the documents; more are joined by shuffle.
BROADCAST_WINDOWS = 1_000_000

# Units of measure, time and money that follow a number, and words for numbers.
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g gram grams kg lb lbs pound pounds oz ounce ounces ton "
    "tons ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks "
    "month months year years $ € £ cent cents dollar dollars euro euros percent mph kmh degrees pages points "
    "millimeter millimeters millimetre millimetres centimeter centimeters centimetre centimetres meter meters metre metres "
    "kilometer kilometers kilometre kilometres milligram milligrams kilogram kilograms kilo kilos tonne tonnes hrs mins secs"
).split()
ONES = "one two three four five six seven eight nine".split()
TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()
NUMBERS = ("zero ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen hundred thousand million "
           "billion dozen").split() + ONES + TENS + [f"{t}-{o}" for t in TENS for o in ONES]
PUNCTUATION = ".,;:!?\"'`()[]{}<>*&|%$#@~^_=+/\\-…«»“”„‘’¿¡"


def tokens(text: Column) -> Column:
    """Words between white space: ``raw``, and as ``core`` without punctuation at their ends."""
    word = F.transform(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda t: F.struct(
        t.alias("raw"), F.btrim(t, F.lit(PUNCTUATION)).alias("core")))
    return F.filter(word, lambda t: t["core"] != "")


def template(words: str) -> Column:
    """The canonical token at each place of a column of ``tokens``; empty where a placeholder before goes on.

    ``<num>`` for a number in digits or words, ``<num><unit>`` for a number grown together with a unit, ``<unit>`` for a
    unit behind a number, ``<name>`` for a capitalised word, else the word in lower case. Names in a row are one,
    and so are number words behind a number, unless punctuation stands between. A word that begins a sentence is
    a ``<name>`` as well: that says nothing about case, so ``leaks`` looks at what stood there. Words in capitals
    throughout are literal.
    """
    digit = lambda c: (c >= "0") & (c < ":")  # noqa: E731  (begins with a digit)
    number = r"^[0-9]+([.,:/][0-9]+)*(st|nd|rd|th)?$"
    joined = r"^[0-9]+([.,][0-9]+)*(" + "|".join(u for u in UNITS if u.isalpha()) + ")$"
    counted = lambda c: F.coalesce(digit(c) | F.lower(c).isin(*NUMBERS), F.lit(False))

    def name(core: Column) -> Column:
        first, second = F.substring(core, 1, 1), F.substring(core, 2, 1)
        return (first != F.lower(first)) & (second != "") & (second == F.lower(second))

    def canonical(t: Column, i: Column) -> Column:
        core, low = t["core"], F.lower(t["core"])
        before = F.get(F.col(words), i - 1)
        goes_on = F.coalesce(F.endswith(before["raw"], before["core"]), F.lit(False))  # no punctuation between
        # Most words are neither: one look into one list.
        return (F.when(digit(core), F.when(core.rlike(number), "<num>").when(low.rlike(joined), "<num><unit>").otherwise(low))
                .when(low.isin(*NUMBERS, *UNITS), F.when(low.isin(*NUMBERS), F.when(goes_on & counted(before["core"]), "").otherwise("<num>"))
                      .when(name(core), F.when(goes_on & name(before["core"]) & ~counted(before["core"]), "").otherwise("<name>"))
                      .otherwise(F.when(counted(before["core"]), "<unit>").otherwise(low)))
                .when(core == low, core)
                .when(name(core), F.when(goes_on & name(before["core"]) & ~counted(before["core"]), "").otherwise("<name>"))
                .otherwise(low))

    return F.transform(F.col(words), canonical)


def plated(df: DataFrame, text: Column, *keep: str) -> DataFrame:
    """``keep`` and, of the text, ``plates`` (its template), ``n`` (their number) and ``pairs``, hashes of each and the next."""
    out = df.select(*keep, tokens(text).alias("words")).select(*keep, F.filter(template("words"), lambda t: t != "").alias("plates"))
    pairs = F.transform("plates", lambda t, i: F.xxhash64(t, F.get("plates", i + 1)))
    return out.withColumn("n", F.size("plates")).withColumn("pairs", pairs)


def windows(length: int) -> Column:
    """``place`` (from 0) and ``hash`` of each window of ``length`` tokens of a row of ``plated``, from its pairs."""
    starts = F.slice("pairs", 1, F.greatest(F.col("n") - length + 1, F.lit(0)))
    odd = [length - 1] if length % 2 else []
    return F.transform(starts, lambda x, i: F.struct(i.alias("place"), F.xxhash64(
        F.lit(length), *[x if a == 0 else F.get("pairs", i + a) for a in range(0, length - 1, 2)], *[F.get("plates", i + a) for a in odd]).alias("hash")))


def detailed(df: DataFrame, text: Column, *keep: str) -> DataFrame:
    """``keep`` and ``cores`` (all words), ``plates``, ``starts`` (the first word of each) and ``values`` (their words, lower case)."""
    out = df.select(*keep, tokens(text).alias("words")).withColumn("raw", template("words")).withColumn("cores", F.col("words.core"))
    every = F.when(F.size("raw") > 0, F.sequence(F.lit(0), F.size("raw") - 1)).otherwise(F.array().cast("array<int>"))
    out = out.withColumn("starts", F.filter(every, lambda i: F.get("raw", i) != ""))
    values = F.transform("starts", lambda s, j: F.lower(F.array_join(F.slice(
        "cores", s + 1, F.coalesce(F.get("starts", j + 1), F.size("cores")) - s), " ")))
    return out.select(*keep, "cores", F.filter("raw", lambda t: t != "").alias("plates"), "starts", values.alias("values"))


def leaks(docs: DataFrame, items: DataFrame, key: str, text: str, item: str, item_text: str,
          broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """One row per document and benchmark item found in it: ``id, text_key, item_id, windows, item_windows, start,
    tokens, kind``.

    An item is found where, in one alignment, half of its distinct windows (or ``ENOUGH``) occur and the placeholders
    correspond: what stands for one number, name or unit of the item is one and the same throughout, though it
    may be another than the item's. Another name counts as one only if it isn't also a word in lower case, in the
    item or in the document: so other words may begin a sentence no more than stand elsewhere. Each item is also
    looked for with its names as plain words, which finds it in capitals or in lower case throughout.

    ``kind`` is ``copy`` if all placeholders are equal and ``reparameterised`` otherwise. ``start`` and ``tokens`` say
    where in the document's words. Of several places the one with most windows counts, then the first. Rows
    without id are found with a null id, ``text_key`` (a hash) then tells texts apart; equal rows give one result.
    Null and empty texts and items without literal tokens match nothing. A text, however long, is one row: its
    template and hashes are arrays of one task, about ten times its size. A window that an item repeats
    is aligned at each of its places.

    Only windows of the documents, as hashes, meet the benchmark's; the documents hit are then read once more for
    the placeholders. The first join broadcasts the benchmark's windows only after counting them. The benchmark's
    templates and windows and the alignments found are written to the shared folder: several plans read each, and
    none holds another's expressions as well, whose size the driver's memory follows.
    """
    source = items.select(F.col(f"`{item}`").alias("item_id"), F.col(f"`{item_text}`").alias("item_text"))
    forms = source.withColumn("form", F.lit(0)).unionByName(source.select("item_id", F.lower("item_text").alias("item_text"), F.lit(1).alias("form")))
    bench = written(plated(forms, F.col("item_text"), "item_id", "form"), "items").where("n > 0")
    lengths = sorted(r[0] for r in bench.where(F.col("n") < TOKENS).select("n").distinct().collect())  # below TOKENS: few
    own = windows(TOKENS)
    for length in lengths:
        own = F.when(F.col("n") == length, windows(length)).otherwise(own)
    literal = lambda w: F.size(F.filter(F.slice("plates", w["place"] + 1, F.lit(TOKENS)), lambda t: ~t.startswith("<")))
    bench = bench.withColumn("own", F.transform(own, lambda w: F.struct(w["place"], w["hash"], literal(w).alias("literal"))))
    least = F.least(F.lit(LITERAL), F.greatest(F.array_max(F.transform("own", lambda w: w["literal"])), F.lit(1)))
    entries = bench.select("item_id", "form", "n", F.explode(F.filter("own", lambda w: w["literal"] >= least)).alias("w")).select(
        "item_id", "form", "n", F.col("w.place").alias("item_place"), F.col("w.hash").alias("hash")).distinct()
    entries = written(entries, "entries")
    many = entries.groupBy("item_id", "form").agg(F.count_distinct("hash").alias("item_windows"))
    known = entries.select("hash").distinct()
    few = known.count() <= broadcast_windows

    rows = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("text_key"), F.col(f"`{text}`").alias("text"))
    every = F.concat(*[windows(length) for length in [*lengths, TOKENS]]) if lengths else windows(TOKENS)
    seen = plated(rows, F.col("text"), "id", "text_key").select("id", "text_key", F.explode(every).alias("w")).select("id", "text_key", "w.place", "w.hash")
    hits = seen.join(F.broadcast(known) if few else known, "hash").distinct()

    shift = (F.col("place") - F.col("item_place")).alias("shift")
    runs = hits.join(entries, "hash").groupBy("id", "text_key", "item_id", "form", "n", shift).agg(
        F.collect_set(F.struct("item_place", "hash")).alias("met"))
    counted = F.size(F.array_distinct(F.transform("met", lambda m: m["hash"])))
    enough = F.col("windows") >= F.least(F.ceil(F.col("item_windows") * SHARE), F.lit(ENOUGH))
    runs = written(runs.withColumn("windows", counted).join(many, ["item_id", "form"]).where(enough), "runs")

    # By columns without nulls: the texts stay where they were dealt to, no shuffle carries their words.
    at = [F.col("id").isNull().alias("none"), F.coalesce("id", F.lit(0)).alias("number"), F.col("text_key").alias("hash")]
    texts = only(rows, runs.select("id", "text_key").distinct(), "id", "text_key").select("text", *at)
    found = detailed(texts.dropDuplicates(["none", "number", "hash"]), F.col("text"), "none", "number", "hash")
    both = runs.select("*", *at).join(found.withColumnRenamed("plates", "doc_plates"), ["none", "number", "hash"]).drop("none", "number", "hash")
    asked = detailed(forms, F.col("item_text"), "item_id", "form").select(
        "item_id", "form", "plates", F.col("cores").alias("item_cores"), F.col("values").alias("item_values"))
    both = both.join(asked, ["item_id", "form"])
    wide = F.least(F.lit(TOKENS), F.col("n"))
    covered = F.array_sort(F.array_distinct(F.flatten(F.transform("met", lambda m: F.sequence(m["item_place"], m["item_place"] + wide - 1)))))
    stands = lambda p: F.get("values", p + F.col("shift"))
    differs = lambda p: F.get("item_values", p) != stands(p)
    # A plain word in the place of a name, as where a sentence begins with another word: windows that hold it don't count.
    word = lambda p: F.array_contains("item_cores", F.get("item_values", p)) | F.array_contains("cores", stands(p))
    both = both.withColumn("covered", covered)
    both = both.withColumn("words", F.filter("covered", lambda p: (F.get("plates", p) == "<name>") & differs(p) & word(p)))
    both = both.withColumn("met", F.when(F.size("words") == 0, F.col("met")).otherwise(F.filter("met", lambda m: ~F.exists(
        "words", lambda p: p.between(m["item_place"], m["item_place"] + wide - 1)))))
    both = both.withColumn("windows", counted).where(enough & (F.size("met") > 0)).withColumn("covered", covered)

    def slot(p: Column) -> Column:
        asked_value, value = F.get("item_values", p), stands(p)
        # Names beside the passage run on into its first or last one.
        first = (p == 0) & F.endswith(value, F.concat(F.lit(" "), asked_value))
        last = (p == F.col("n") - 1) & F.startswith(value, F.concat(asked_value, F.lit(" ")))
        return F.struct(F.get("plates", p).alias("type"), asked_value.alias("item"), F.when(first | last, asked_value).otherwise(value).alias("doc"))

    slots = F.array_distinct(F.transform(F.filter("covered", lambda p: F.get("plates", p).startswith("<")), slot))
    both = both.withColumn("slots", slots)
    one = F.size(F.array_distinct(F.transform("slots", lambda s: F.struct(s["type"], s["item"])))) == F.size("slots")
    plain = (F.col("form") == 0) | ~F.exists(F.sequence(F.lit(0), F.col("n") - 1), lambda p: (
        F.get("doc_plates", p + F.col("shift")) == "<name>") & F.coalesce(differs(p), F.lit(False)))
    begins = lambda p: F.coalesce(F.get("starts", p), F.size("cores"))
    both = both.where(one & plain).select(
        "id", "text_key", "item_id", "form", "windows", "item_windows", begins(F.array_min("covered") + F.col("shift")).alias("start"),
        F.aggregate("covered", F.lit(0), lambda s, p: s + begins(p + F.col("shift") + 1) - begins(p + F.col("shift"))).alias("tokens"),
        F.when(F.forall("slots", lambda s: s["item"] == s["doc"]), "copy").otherwise("reparameterised").alias("kind"))
    best = Window.partitionBy("id", "text_key", "item_id").orderBy("form", F.desc("windows"), "start")
    return both.withColumn("_n", F.row_number().over(best)).where("_n = 1").drop("_n", "form")
