"""Benchmark decontamination by template windows.

One pass over a text takes its tokens: numbers (separators and decimals included), capitalised words with those that
follow them (one name), and other words of letters and digits.  A token's type depends on nothing but itself, so a text
has the same template wherever it stands: a number or a number word is ``#``, a unit behind one ``~``, a word of mixed
case or a run of capitalised words ``@``; all others are lower-cased.  Windows of WINDOW template tokens are hashed (an
item with fewer tokens is one window) and join documents to benchmark items; what the join finds is compared token by
token afterwards.

A capitalised word at the beginning of a sentence is a name only if the item has it elsewhere too (``Tom has ... Tom
gives``, ``... to Tom``).  Otherwise (``What is``) it is fixed: it counts as a literal word, and a document must have the
same word there, in either case.  Only windows with MIN_LITERAL literal words count, so templates of numbers and names
alone match nothing; an item without such a window is matched by its values themselves, and all of it has to be there.

Each other placeholder of an item stands for one value of the document, however many words it has: its own where that
occurs, else the most frequent (of equally frequent ones the greatest).  Windows over any other value are dropped, all
others count; two values of an item may become one.  A document is contaminated by an item if it holds COVERAGE of the
item's windows.  DataFrame functions only.

An item that needs m of its n windows is held by no document without one of any n - m + 1 of them, so documents are
joined to each item's n - m + 1 windows that fewest items share; all windows are compared for the pairs found.  Windows
that many items begin with therefore make no rows.  The rare windows are sent to all executors if they are at most
BROADCAST_WINDOWS (16 bytes each); beyond that the join is a shuffle.

Cases: a null or empty text, or one without letters and digits, has no windows; such an item matches nothing.  A null
``doc_id`` is reported as null.  Repeated rows are reported once; items that share an ``item_id`` with different texts
are items of their own.  Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaxmart.llm.common import cut, prepare, whole

WINDOW, COVERAGE, MIN_LITERAL = 5, 0.75, 3
BROADCAST_WINDOWS = 2_000_000
BROADCAST_KEYS = 500_000  # documents, 32 bytes each
#: Fixed list of units that count after a number.
UNITS = ("mm cm dm m km inch inches foot feet mile miles mg g kg lb lbs pound pounds ton tons ml cl l litre litres liter liters "
         "s sec second seconds min minute minutes h hour hours day days week weeks month months year years "
         "dollar dollars cent cents euro euros percent degrees hz khz mhz w kw kwh mph kmh").split()
#: Fixed lists of number words in English, German, French and Spanish (articles left out).
NUMBER_WORDS = sorted(set(
    ("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen "
     "twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million "
     "null eins zwei drei vier fünf sechs sieben acht neun zehn elf zwölf zwanzig dreißig vierzig fünfzig sechzig siebzig achtzig neunzig "
     "hundert tausend deux trois quatre cinq sept huit neuf dix onze douze vingt trente quarante cinquante soixante cent mille "
     "dos tres cuatro cinco seis siete ocho nueve diez once doce veinte treinta cuarenta cincuenta sesenta setenta ochenta noventa cien mil").split())
    - {"cent", "null", "once"})  # units and words of another language

_CAPITAL = r"\p{Lu}\p{Ll}[\p{L}\p{M}\p{Nd}]*"
_TOKEN = rf"{_CAPITAL}(?:[ -]{_CAPITAL})*|[0-9]+(?:[.,][0-9]+)*|[\p{{L}}\p{{M}}\p{{Nd}}]+"
_STOP = r"[.!?:]"


def tokens_of(text: Column) -> Column:
    return F.regexp_extract_all(whole(text), F.lit(_TOKEN), F.lit(0))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value made once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def template_of(tokens: Column) -> Column:
    """The tokens with typed placeholders, one for one."""
    def of(t: Column) -> Column:
        number = lambda x: x.isin(*NUMBER_WORDS)
        return F.when(F.ascii(t).between(48, 57), "#").when(t == F.lower(t), F.when(number(t), "#").otherwise(t)).when(
            number(F.lower(t)), "#").when(t != F.upper(t), "@").otherwise(F.lower(t))

    return _let(F.transform(tokens, of), lambda ts: F.transform(
        ts, lambda t, i: F.when((F.get(ts, i - 1) == "#") & t.isin(*UNITS), "~").otherwise(t)))


def _hashes(tokens: Column, sizes: list[int], *seed: Column) -> Column:
    """Hashes of all windows of the given sizes."""
    def of(n: int) -> Column:
        return F.when(F.size(tokens) >= n, F.transform(
            F.sequence(F.lit(0), F.size(tokens) - n), lambda i: F.xxhash64(F.lit(n), *seed, F.slice(tokens, i + 1, n)))).otherwise(
            F.array().cast("array<bigint>"))

    return F.concat(*map(of, sizes))


def _places(tokens: Column, sizes: list[int], *seed: Column) -> Column:
    """(at, h) of all windows of the given sizes."""
    def of(n: int) -> Column:
        return F.when(F.size(tokens) >= n, F.transform(F.sequence(F.lit(0), F.size(tokens) - n), lambda i: F.struct(
            i.alias("at"), F.xxhash64(F.lit(n), *seed, F.slice(tokens, i + 1, n)).alias("h")))).otherwise(
            F.array().cast("array<struct<at:int,h:bigint>>"))

    return F.concat(*map(of, sizes))


def _slot(t: Column) -> Column:
    return t.isin("#", "~", "@")


def item_views(benchmark: DataFrame) -> DataFrame:
    """(item, item_id, words, tokens, fixed): values, template and fixed words of each distinct benchmark row with a token."""
    raw = F.regexp_extract_all(whole(F.col("text")), F.lit(f"{_TOKEN}|{_STOP}"), F.lit(0))
    rows = benchmark.select("item_id", raw.alias("raw")).distinct()
    stop = lambda t: t.rlike(f"^{_STOP}$")
    marked = F.transform("raw", lambda t, i: F.struct(t.alias("t"), ((i == 0) | stop(F.get("raw", i - 1))).alias("start")))
    rows = rows.select("item_id", F.filter(marked, lambda s: ~stop(s["t"])).alias("marked")).where(F.size("marked") > 0)
    rows = rows.withColumn("words", F.transform("marked", lambda s: F.lower(s["t"])))
    rows = rows.withColumn("tokens", template_of(F.transform("marked", lambda s: s["t"])))
    once = lambda w: F.size(F.filter("words", lambda x: x == w)) == 1
    rows = rows.withColumn("fixed", F.transform("tokens", lambda t, i: (t == "@") & F.get("marked", i)["start"] & once(F.get("words", i))))
    return rows.select(F.monotonically_increasing_id().alias("item"), "item_id", "words", "tokens", "fixed")


def item_windows(items: DataFrame) -> DataFrame:
    """(item, at, h, exact, n, least): the windows that count, hashed as documents may have them; how many, and how many are needed."""
    size = F.least(F.size("tokens"), F.lit(WINDOW))
    part = lambda c: F.slice(c, F.col("at") + 1, size)
    places = items.select("*", size.alias("size"), F.explode(F.sequence(F.lit(0), F.size("tokens") - size)).alias("at"))
    fixed = F.zip_with(part("tokens"), part("fixed"), lambda t, f: ~_slot(t) | f)
    rich = places.where(F.size(F.filter(fixed, lambda x: x)) >= F.least(F.lit(MIN_LITERAL), F.col("size")))
    written = F.zip_with(F.zip_with(part("tokens"), part("words"), lambda t, w: F.struct(t.alias("t"), w.alias("w"))), part("fixed"),
                         lambda x, f: F.when(f, x["w"]).otherwise(x["t"]))
    both = F.array_distinct(F.array(*[F.xxhash64(F.col("size"), c) for c in (part("tokens"), written)]))
    typed = rich.select("item", "at", "size", F.explode(both).alias("h"), F.lit(False).alias("exact"))
    poor = places.join(rich.select("item").distinct(), "item", "left_anti")
    exact = poor.select("item", "at", "size", F.xxhash64(F.col("size"), F.lit("="), part("words")).alias("h"), F.lit(True).alias("exact"))
    every = typed.unionByName(exact)
    totals = every.groupBy("item").agg(F.count_distinct("at").alias("n"), F.max(F.when(F.col("exact"), 1.0).otherwise(COVERAGE)).alias("needed"))
    return every.join(totals.select("item", "n", F.ceil(F.col("needed") * F.col("n")).alias("least")), "item")


def rare_windows(windows: DataFrame) -> DataFrame:
    """(item, h) of each item's n - least + 1 windows that fewest windows of the benchmark equal."""
    shared = windows.groupBy("h").agg(F.count(F.lit(1)).alias("shared"))
    places = windows.join(shared, "h").groupBy("item", "at", "n", "least").agg(F.max("shared").alias("shared"), F.collect_set("h").alias("hs"))
    ranked = places.groupBy("item", "n", "least").agg(F.sort_array(F.collect_list(F.struct("shared", "at", "hs"))).alias("all"))
    return ranked.select("item", F.explode(F.slice("all", F.lit(1), (F.col("n") - F.col("least") + 1).cast("int"))).alias("w")).select(
        "item", F.explode("w.hs").alias("h")).distinct()


def _key(doc_id: Column, text: Column) -> Column:
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("-")), F.lit("|"), text))


def _few(keys: DataFrame) -> DataFrame:
    """Written keys, to be broadcast if they are at most BROADCAST_KEYS: only beyond that are documents shuffled."""
    keys = cut(keys, "keys")
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and item it holds: doc_id, key, item_id, n_windows, n_item_windows, coverage, n_changed.

    ``key`` is a digest of the id and the text; ``n_changed`` counts the different replacements of the item's values."""
    prepare(docs.sparkSession)
    items = cut(item_views(benchmark), "items")
    windows = cut(item_windows(items), "windows")
    typed_sizes, exact_sizes = ([r["n"] for r in items.join(windows.where(c).select("item").distinct(), "item", "left_semi").select(
        F.least(F.size("tokens"), F.lit(WINDOW)).alias("n")).distinct().orderBy("n").collect()] for c in (~F.col("exact"), F.col("exact")))
    rare = cut(rare_windows(windows), "rare")
    sent = F.broadcast(rare) if rare.count() <= BROADCAST_WINDOWS else rare

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole(F.col("text")).alias("text"))

    def made(tokens: Column, how) -> Column:
        """All windows of a text, the typed ones and those of values; its tokens are made once."""
        parts = [lambda t: _let(template_of(t), lambda x: how(x, typed_sizes))] if typed_sizes else []
        parts += [lambda t: _let(F.transform(t, F.lower), lambda x: how(x, exact_sizes, F.lit("=")))] if exact_sizes else []
        return _let(tokens, lambda t: F.concat(*[p(t) for p in parts])) if parts else how(tokens, [])

    if not typed_sizes and not exact_sizes:
        rows, typed_sizes = rows.where("false"), [WINDOW]
    tokens = tokens_of(F.col("text"))
    found = cut(rows.select("doc_id", _key(F.col("doc_id"), F.col("text")).alias("key"), F.explode(made(tokens, _hashes)).alias("h"))
                .join(sent, "h").select("doc_id", "key", "item").distinct(), "candidates")

    # All windows of the pairs found, each at its place.
    keys = _few(found.select(F.col("key").alias("found_key")).distinct())
    rows = rows.withColumn("key", _key(F.col("doc_id"), F.col("text"))).join(keys, F.col("key") == F.col("found_key"), "left_semi")
    rows = cut(rows.dropDuplicates(["key"]).select("key", tokens.alias("raw")), "held")
    places = rows.select("key", F.explode(made(F.col("raw"), _places)).alias("w")).select("key", F.col("w.at").alias("at"), F.col("w.h").alias("h"))
    wanted = found.join(windows.select("item", "h", F.col("at").alias("item_at")), "item")
    hits = (wanted.join(places, ["key", "h"]).groupBy("key", "doc_id", "item", (F.col("at") - F.col("item_at")).alias("shift"))
            .agg(F.collect_set("item_at").alias("at")))

    placed = hits.join(rows, "key").join(items, "item")
    placed = placed.withColumn("doc_words", F.transform("raw", F.lower)).withColumn("doc_tokens", template_of(F.col("raw")))
    last = F.least(F.size("tokens"), F.lit(WINDOW)) - 1
    at = lambda c, i: F.get(c, i)
    there = lambda c, i: F.get(c, i + F.col("shift"))
    # The hashes, confirmed on the words.
    equal = lambda i: (at("tokens", i) == there("doc_tokens", i)) | (at("words", i) == there("doc_words", i))
    placed = placed.withColumn("at", F.filter("at", lambda a: F.forall(F.sequence(a, a + last), equal)))
    under = F.array_distinct(F.flatten(F.transform("at", lambda a: F.sequence(a, a + last))))
    placed = placed.withColumn("slots", F.transform(F.filter(under, lambda i: _slot(at("tokens", i))), lambda i: F.struct(
        i.alias("i"), at("words", i).alias("x"), there("doc_words", i).alias("y"), at("fixed", i).alias("fixed"))))
    # Every value of the item stands for the best of the values that take its place; a run of names may end with a fixed word.
    free = F.filter("slots", lambda s: ~s["fixed"])
    placed = placed.withColumn("pairs", F.array_distinct(F.transform(free, lambda s: F.struct(s["x"].alias("x"), s["y"].alias("y")))))
    placed = placed.withColumn("pairs", F.transform("pairs", lambda p: F.struct(p["x"].alias("x"), F.struct(
        (p["x"] == p["y"]).alias("same"),
        F.size(F.filter("slots", lambda s: ~s["fixed"] & (s["x"] == p["x"]) & (s["y"] == p["y"]))).alias("n"), p["y"].alias("y")).alias("rank"))))
    other = lambda s: F.exists("pairs", lambda p: (p["x"] == s["x"]) & (p["rank"]["y"] == s["y"]) & F.exists(
        "pairs", lambda q: (q["x"] == p["x"]) & (q["rank"] > p["rank"])))
    moved = lambda s: (s["x"] != s["y"]) & ~F.endswith(s["y"], F.concat(F.lit(" "), s["x"]))
    placed = placed.withColumn("lost", F.transform(
        F.filter("slots", lambda s: F.when(s["fixed"], moved(s)).otherwise(other(s))), lambda s: s["i"]))
    kept = F.filter("at", lambda a: ~F.exists("lost", lambda i: i.between(a, a + last)))
    changed = F.size(F.filter("pairs", lambda p: ~p["rank"]["same"]))
    totals = windows.select("item", "n", "least").distinct()
    return (
        placed.select("key", "doc_id", "item", "item_id", F.explode(kept).alias("at"), changed.alias("changed"))
        .groupBy("key", "doc_id", "item", "item_id")
        .agg(F.count_distinct("at").alias("n_windows"), F.max("changed").cast("long").alias("n_changed"))
        .join(totals, "item").where("n_windows >= least")
        .select("doc_id", "key", "item_id", "n_windows", F.col("n").alias("n_item_windows"), (F.col("n_windows") / F.col("n")).alias("coverage"), "n_changed")
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item."""
    names = docs.columns
    inner = docs.toDF(*[f"c{i}" for i in range(len(names))])
    lower = [n.lower() for n in names]
    text, doc_id = F.col(f"c{lower.index('text')}"), F.col(f"c{lower.index('doc_id')}")
    found = _few(contaminated(docs, benchmark).select("key").distinct())
    keyed = inner.withColumn("key", _key(doc_id.cast("long"), whole(text)))
    return keyed.join(found, "key", "left_anti").drop("key").toDF(*names)


def _list(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _typed(table: str, columns: str) -> str:
    """Template tokens of a table of tokens (``columns``, i, t), units by the token before."""
    kind = (f"CASE WHEN ascii(t) BETWEEN 48 AND 57 OR lower(t) IN ({_list(NUMBER_WORDS)}) THEN '#' "
            f"WHEN t <> lower(t) AND t <> upper(t) THEN '@' ELSE lower(t) END")
    return (f"SELECT *, CASE WHEN k IN ({_list(UNITS)}) AND lag(k) OVER (PARTITION BY {columns} ORDER BY i) = '#' THEN '~' ELSE k END AS token "
            f"FROM (SELECT *, lower(t) AS word, {kind} AS k FROM {table})")


ORACLE = f"""
WITH raw AS (
  SELECT row_number() OVER () AS item, item_id, ts FROM (
    SELECT DISTINCT item_id, regexp_extract_all(coalesce(text, ''), '{_TOKEN}|{_STOP}') AS ts FROM benchmark)
), part AS (
  SELECT item, item_id, unnest(ts) AS t, generate_subscripts(ts, 1) AS p FROM raw
), started AS (
  SELECT *, coalesce(regexp_matches(lag(t) OVER (PARTITION BY item ORDER BY p), '^{_STOP}$'), true) AS starts FROM part
), numbered AS (
  SELECT item, item_id, t, starts, row_number() OVER (PARTITION BY item ORDER BY p) AS i FROM started WHERE NOT regexp_matches(t, '^{_STOP}$')
), tok AS ({_typed('numbered', 'item')}
), it AS (
  SELECT *, token = '@' AND starts AND count(*) OVER (PARTITION BY item, word) = 1 AS fixed, count(*) OVER (PARTITION BY item) AS total FROM tok
), pos AS (
  SELECT item, item_id, total, least(total, {WINDOW}) AS size, i AS place_at FROM it WHERE i <= total - least(total, {WINDOW}) + 1
), win AS (
  SELECT pos.item, pos.item_id, size, place_at, list(it.token ORDER BY it.i) AS ts, list(it.word ORDER BY it.i) AS ws, list(it.fixed ORDER BY it.i) AS fs,
         count(*) FILTER (it.token NOT IN ('#', '~', '@') OR it.fixed) >= least({MIN_LITERAL}, size) AS rich
  FROM pos JOIN it ON it.item = pos.item AND it.i BETWEEN place_at AND place_at + size - 1 GROUP BY 1, 2, 3, 4
), counted AS (
  SELECT *, NOT bool_or(rich) OVER (PARTITION BY item) AS exact FROM win
), bench AS (SELECT * FROM counted WHERE rich OR exact),
total AS (
  SELECT item, any_value(item_id) AS item_id, count(*) AS n, CASE WHEN any_value(exact) THEN count(*) ELSE ceil({COVERAGE} * count(*)) END AS least
  FROM bench GROUP BY 1
), doc AS (
  SELECT row_number() OVER () AS doc, doc_id, ts FROM (
    SELECT DISTINCT doc_id, regexp_extract_all(text, '{_TOKEN}') AS ts, text FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents))
), dpart AS (SELECT doc, unnest(ts) AS t, generate_subscripts(ts, 1) AS i FROM doc),
dtok AS ({_typed('dpart', 'doc')}),
full_doc AS (SELECT doc, list(token ORDER BY i) AS ts, list(word ORDER BY i) AS ws FROM dtok GROUP BY 1),
dw AS (
  SELECT doc, size, place_at, ts[place_at:place_at + size - 1] AS ts, ws[place_at:place_at + size - 1] AS ws
  FROM (SELECT full_doc.*, s.size, unnest(range(1, len(ts) - s.size + 2)) AS place_at FROM full_doc, (SELECT DISTINCT size FROM bench) s)
), form AS (
  SELECT item, size, place_at, ts AS look, false AS exact FROM bench WHERE NOT exact
  UNION SELECT item, size, place_at, list_transform(range(1, size + 1), lambda k: CASE WHEN fs[k] THEN ws[k] ELSE ts[k] END), false FROM bench WHERE NOT exact
), hit AS (
  SELECT DISTINCT doc, form.item, form.place_at, dw.place_at - form.place_at AS shift, form.size
  FROM dw JOIN form ON form.size = dw.size AND form.look = dw.ts
  UNION SELECT doc, item, bench.place_at, dw.place_at - bench.place_at, bench.size FROM dw JOIN bench ON bench.exact AND bench.size = dw.size AND bench.ws = dw.ws
), under AS (
  SELECT DISTINCT doc, item, shift, unnest(range(place_at, place_at + size)) AS i FROM hit
), slot AS (
  SELECT u.doc, u.item, u.shift, u.i, it.word AS x, dtok.word AS y, it.fixed
  FROM under u JOIN it ON it.item = u.item AND it.i = u.i JOIN dtok ON dtok.doc = u.doc AND dtok.i = u.i + u.shift WHERE it.token IN ('#', '~', '@')
), pair AS (
  SELECT doc, item, shift, x, y, row_number() OVER (PARTITION BY doc, item, shift, x ORDER BY x = y DESC, count(*) DESC, y DESC) AS place
  FROM slot WHERE NOT fixed GROUP BY 1, 2, 3, 4, 5
), lost AS (
  SELECT doc, item, shift, i FROM slot WHERE fixed AND x <> y AND NOT ends_with(y, ' ' || x)
  UNION SELECT doc, item, shift, i FROM slot JOIN pair USING (doc, item, shift, x, y) WHERE NOT fixed AND place > 1
), changed AS (
  SELECT doc, item, shift, count(*) FILTER (x <> y) AS changed FROM pair GROUP BY 1, 2, 3
), held AS (
  SELECT h.doc, h.item, count(DISTINCT h.place_at) AS n_windows, max(coalesce(c.changed, 0)) AS n_changed
  FROM hit h LEFT JOIN changed c USING (doc, item, shift)
  WHERE NOT EXISTS (SELECT 1 FROM lost l WHERE l.doc = h.doc AND l.item = h.item AND l.shift = h.shift AND l.i BETWEEN h.place_at AND h.place_at + h.size - 1)
  GROUP BY 1, 2
)
SELECT doc.doc_id, total.item_id, n_windows, n AS n_item_windows, n_windows / n AS coverage, n_changed
FROM held JOIN total USING (item) JOIN doc USING (doc) WHERE n_windows >= least
"""
