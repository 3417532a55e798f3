"""Quotes of functions that send data: which they are, who calls them, how they score, and which a digest keeps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.functions.text import let
from shelfspark.operators import quotes, source_code
from shelfspark.plans.lineage import cut

#: Lines before and after a send outside of all functions, and around a call of a sending function.
LOOSE_FRAME, CALLER_FRAME = (quotes.OUTBOUND_BEFORE, 8), (2, 2)


def walk(path: Column) -> Column:
    """Sorts paths as a walk of the tree meets them: folder by folder, by name."""
    return F.split(path, "/")


def flagged_calls(code: DataFrame, tree: str = "tree_id") -> DataFrame:
    """(tree, path, line, at, order, callee, sends, device, span): calls that send or read the device, each with its innermost function.

    ``code`` is ``source_code.parsed``. ``span`` is null for calls outside of all functions.
    """
    calls = source_code.calls_of(code, tree).withColumn("sends", quotes.sends_data(F.col("callee"))).withColumn("device", quotes.device_fact(F.col("callee")))
    told = calls.filter(F.col("sends") | (F.col("device") != ""))
    return source_code.enclosing(told, source_code.functions_of(code, tree), [tree, "path"])


def flagged_functions(calls: DataFrame, tree: str = "tree_id") -> DataFrame:
    """(tree, path, fn, name, begin, stop, sends, devices, focus) of the functions of ``flagged_calls``.

    ``fn`` is the place where a function begins, -1 for what is outside of all;
    that counts as one function without name, begin and stop. ``focus`` is the
    line of the first call that sends, or else of the first.
    """
    fn = F.coalesce("span.begin_at", F.lit(-1)).alias("fn")
    g = calls.groupBy(tree, "path", fn, F.col("span.name").alias("name"), F.col("span.begin").alias("begin"), F.col("span.stop").alias("stop"))
    return g.agg(F.max("sends").alias("sends"), F.array_sort(F.collect_set(F.when(F.col("device") != "", F.col("device")))).alias("devices"), F.coalesce(F.min(F.when(F.col("sends"), F.col("line"))), F.min("line")).alias("focus"))


def frame(functions: DataFrame) -> DataFrame:
    """``functions`` with a and b, the lines (from 0) that are quoted: the function, or so many lines around its focus."""
    at = F.col("focus") - 1
    loose = F.col("begin").isNull()
    a = F.when(loose, at - LOOSE_FRAME[0]).otherwise(F.col("begin") - 1)
    b = F.when(loose, at + LOOSE_FRAME[1]).otherwise(F.col("stop") - 1)
    long = b - a > quotes.OUTBOUND_LINES
    cut = at - quotes.OUTBOUND_LINES // 3
    return functions.withColumn("a", F.when(long, cut).otherwise(a)).withColumn("b", F.when(long, cut + quotes.OUTBOUND_LINES).otherwise(b))


def callers(functions: DataFrame, calls: DataFrame, code: DataFrame, tree: str = "tree_id") -> DataFrame:
    """(tree, path, fn, caller_path, caller_line): for each sending function with a telling name the first other function that calls it.

    Functions go by path, then begin. In one, a call that was told from the
    code counts before a mention in a line. Names meet what is called by a join
    on the name; mentions that nobody asks for are dropped before anything is
    sorted.
    """
    wanted = functions.filter(F.col("sends") & quotes.linkable(F.col("name"))).select(tree, F.col("path").alias("__path"), F.col("fn").alias("__fn"), F.lower("name").alias("called"))
    told = calls.select(tree, "path", F.lower(quotes.last_name(F.col("callee"))).alias("called"), F.coalesce("span.begin_at", F.lit(-1)).alias("fn"), F.lit(0).alias("kind"), "line")
    said = code.select(tree, "path", F.inline("mentions")).join(wanted.select(tree, "called").distinct(), [tree, "called"], "left_semi")
    spans = source_code.functions_of(code, tree).select(tree, "path", "begin_at", "stop_at")
    around = lambda depth: source_code.enclosing(said, spans, [tree, "path"], depth).filter("span IS NOT NULL").select(tree, "path", "called", F.col("span.begin_at").alias("fn"), F.lit(1).alias("kind"), "line")
    # The outermost function around a mention comes first; if it is the wanted one itself, the one inside it.
    found = told.unionByName(around(1)).unionByName(around(2))
    met = wanted.join(found, [tree, "called"]).filter((F.col("path") != F.col("__path")) | (F.col("fn") != F.col("__fn")))
    first = met.groupBy(tree, "__path", "__fn").agg(F.min(F.struct("path", "fn", "kind", "line")).alias("c"))
    return first.select(tree, F.col("__path").alias("path"), F.col("__fn").alias("fn"), F.col("c.path").alias("caller_path"), F.col("c.line").alias("caller_line"))


def _quoted(files: DataFrame, spans: DataFrame, tree: str) -> DataFrame:
    """(tree, path, fn, part, quote) of spans (tree, file, path, fn, part, a, b); ``quote`` are (line, path, text) of the telling lines a to b of ``file``.

    A file's lines are trimmed and clipped once and before they travel, and a
    span takes its own out of them, so neither a text of long lines nor a row
    per line is shuffled.
    """
    per_file = spans.groupBy(tree, "file").agg(F.collect_list(F.struct(*[c for c in spans.columns if c not in (tree, "file")])).alias("__s"))
    lines = files.select(tree, F.col("path").alias("file"), quotes.telling_lines(F.split("body", "\n")).alias("__lines"))

    def quote(s: Column) -> Column:
        a, b = F.greatest(s["a"], F.lit(0)), F.least(s["b"], F.size("__lines") - 1)
        each = F.transform(F.slice("__lines", a + 1, F.greatest(b - a + 1, F.lit(0))), lambda x, i: F.struct((a + i + 1).alias("line"), F.col("file").alias("path"), x.alias("text")))
        return F.struct(s["path"].alias("path"), s["fn"].alias("fn"), s["part"].alias("part"), F.filter(each, lambda x: x["text"].isNotNull()).alias("quote"))

    return lines.join(per_file, [tree, "file"]).select(tree, F.inline(F.transform("__s", quote)))


def sink_groups(files: DataFrame, code: DataFrame, tree: str = "tree_id") -> DataFrame:
    """(tree, path, fn, begin, stop, score, lines) of every function that sends data.

    ``lines`` are (path, line, text) of the function and of the lines around the
    call in one caller. The score is that of ``quotes.group_score`` with hosts
    of the own file, 3 more if the function reads the device or a line names it.
    """
    calls = cut(flagged_calls(code, tree), "flagged-calls")
    functions = flagged_functions(calls, tree).filter("sends")
    own = frame(functions).select(tree, "path", "fn", F.col("path").alias("file"), F.lit(0).alias("part"), "a", "b")
    linked = callers(functions, calls, code, tree).select(tree, "path", "fn", F.col("caller_path").alias("file"), F.lit(1).alias("part"), (F.col("caller_line") - 1 - CALLER_FRAME[0]).alias("a"), (F.col("caller_line") - 1 + CALLER_FRAME[1]).alias("b"))
    parts = _quoted(files, own.unionByName(linked), tree).filter(F.size("quote") > 0)
    in_order = F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("part", "quote"))), lambda x: x["quote"]))
    g = parts.groupBy(tree, "path", "fn").agg(in_order.alias("l")).withColumn("lines", F.transform("l", lambda x: F.struct(x["path"], x["line"], x["text"]))).drop("l")
    g = g.join(functions.select(tree, "path", "fn", "begin", "stop", "devices"), [tree, "path", "fn"])
    return g.withColumn("score", score(F.col("lines"), F.col("path"), F.size("devices") > 0)).select(tree, "path", "fn", "begin", "stop", "score", "lines")


def score(lines: Column, path: Column, device: Column | None) -> Column:
    text = F.array_join(F.transform(lines, lambda x: x["text"]), "\n")
    own = F.array_join(F.transform(F.filter(lines, lambda x: x["path"] == path), lambda x: x["text"]), "\n")

    def of(t: Column) -> Column:
        base = quotes.body_score(t["low"], quotes.domains(t["own"]))
        return base if device is None else base + F.when(device | quotes.any_of(t["low"], quotes.DEVICE_TOKENS), 3).otherwise(0)

    return let(F.struct(F.lower(text).alias("low"), own.alias("own")), of)


def outbound(files: DataFrame, code: DataFrame, tree: str = "tree_id", most: int = quotes.OUTBOUND_FILES) -> DataFrame:
    """(tree, pos, path, line, text): lines of the ``most`` best groups of a tree, as a digest quotes them.

    Files whose language is read give a group per sending function, other code
    files one of the lines around what sends. Higher scores come first; of
    equal ones files before functions, files as a walk meets them, functions by
    path and begin. ``files`` are code files (tree, path, body).
    """
    other = files.filter(~source_code.has_grammar(F.col("path")))
    by_line = quotes.outbound_lines(other, tree).groupBy(tree, "path").agg(F.array_sort(F.collect_list(F.struct("line", "text"))).alias("l"))
    by_line = by_line.select(tree, "path", F.transform("l", lambda x: F.struct(F.col("path").alias("path"), x["line"].alias("line"), x["text"].alias("text"))).alias("lines"))
    by_line = by_line.select(tree, score(F.col("lines"), F.col("path"), None).alias("score"), F.struct(F.lit(0).alias("kind"), walk(F.col("path")).alias("walk"), F.col("path").alias("path"), F.lit(0).alias("fn")).alias("place"), "lines")
    none = F.array().cast("array<string>")
    by_function = sink_groups(files, code, tree).select(tree, "score", F.struct(F.lit(1).alias("kind"), none.alias("walk"), F.col("path").alias("path"), F.col("fn").alias("fn")).alias("place"), "lines")
    nth = F.row_number().over(Window.partitionBy(tree).orderBy(F.desc("score"), "place"))
    best = by_line.unionByName(by_function).withColumn("nth", nth).filter(F.col("nth") <= most)
    each = best.select(tree, "nth", F.posexplode("lines").alias("k", "l"))
    return each.select(tree, F.row_number().over(Window.partitionBy(tree).orderBy("nth", "k")).alias("pos"), "l.path", "l.line", "l.text")


def device_quotes(code: DataFrame, asked: DataFrame, tree: str = "tree_id") -> DataFrame:
    """(tree, fact, score, path, a, b): for each asked fact (tree, fact) the function whose code reads that from the device.

    7 if it also sends data, else 6; of equal ones the last by path and begin.
    A call for the location stands for both kinds of it, one for messages for
    reading, receiving and sending them.
    """
    functions = frame(flagged_functions(flagged_calls(code, tree), tree).filter(F.size("devices") > 0))
    each = functions.select(tree, "path", "fn", F.when(F.col("sends"), 7).otherwise(6).alias("score"), "a", "b", F.explode("devices").alias("device"))
    wide = F.lit(None).cast("array<string>")
    for fact, names in quotes.SHEET_FACTS.items():
        wide = F.when(F.col("device") == fact, F.array(*map(F.lit, names))).otherwise(wide)
    known = each.withColumn("fact", F.explode(F.coalesce(wide, F.array("device")))).join(asked.select(tree, "fact").distinct(), [tree, "fact"], "left_semi")
    best = known.groupBy(tree, "fact").agg(F.max(F.struct("score", "path", "fn", "a", "b")).alias("q"))
    return best.select(tree, "fact", "q.score", "q.path", "q.a", "q.b")
