"""Elements of one array in JSON files of any size, read in byte ranges by many tasks.

Where a range begins is unknown in itself: it may lie inside a string, at any depth. A first pass
over the ranges counts quotes and brackets under both assumptions. Prefix sums over a file's ranges
then tell each one's true state, a second pass finds where the array begins and ends, and a third
emits each element from the range that it starts in, reading on beyond the range's end for the last.
A worker holds one range and one element at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from gridspark.session import ensure_checkpoint_dir
from gridspark.sources.seek import dealt, opener

RANGE_BYTES = 4 * 1024 * 1024
BROKEN_ANSWER, NO_ITEMS, NOT_UTF8 = "broken_answer", "no_items", "not_utf8"
COUNTED = "path string, begin bigint, finish bigint, quotes bigint, outside bigint, inside bigint, utf8 boolean"
EVENTS = "path string, at bigint, kind int"
ELEMENTS = "path string, at bigint, element string"


def range_reader():
    """Functions over an open file: the structure of a byte range, and what stands before a place."""
    import re

    import numpy as np

    def part(file, begin, finish):
        file.seek(begin)
        return file.read(finish - begin)

    def backslashes_before(file, at):
        """How many backslashes stand directly before a place."""
        count, step = 0, 64
        while at > 0:
            begin = max(0, at - step)
            seen = part(file, begin, at)
            trailing = len(seen) - len(seen.rstrip(b"\\"))
            count += trailing
            if trailing < len(seen):
                break
            at, step = begin, step * 2
        return count

    def unescaped_quotes(data, before):
        """Quotes that an even number of backslashes stands before."""
        places = np.arange(len(data))
        other = np.maximum.accumulate(np.where(data != 92, places, -1)) if len(data) else places
        last = np.concatenate([[-1], other[:-1]])
        run = places - 1 - last + np.where(last < 0, before, 0)
        return (data == 34) & (run % 2 == 0)

    def brackets(data, quotes, in_string):
        """+1 and -1 where a bracket outside of strings opens and closes."""
        inside = (np.cumsum(quotes) - quotes + in_string) % 2 == 1
        plain = ~inside & ~quotes
        return (plain & ((data == 123) | (data == 91))).astype(np.int64) - (plain & ((data == 125) | (data == 93)))

    def utf8(raw):
        """Whether a range is UTF-8 but for characters that its borders cut."""
        first = 0
        while first < min(3, len(raw)) and raw[first] & 0xC0 == 0x80:
            first += 1
        try:
            raw[first:].decode("utf-8")
        except UnicodeDecodeError as error:
            return error.reason == "unexpected end of data" and error.start >= len(raw) - first - 3
        return True

    def key_before(file, at):
        """The key whose value begins at a place, or None."""
        step = 256
        while True:
            seen = part(file, max(0, at - step), at)
            found = re.search(rb'"((?:[^"\\]|\\.)*)"\s*:\s*\Z', seen, re.S)
            # A match that begins where the bytes seen do may have lost its first part.
            if found and (found.start() > 0 or at <= step):
                return found[1]
            if at <= step or (not found and seen.rstrip()[-1:] != b":" and seen.strip()):
                return None
            step *= 2

    return part, backslashes_before, unescaped_quotes, brackets, utf8, key_before


def ranges_of(files: DataFrame, range_bytes: int) -> DataFrame:
    """`path, begin, finish` of every range, from `path` and `length`."""
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(range_bytes).cast("bigint")))
    return files.filter(F.col("length") > 0).select("path", "length", starts.alias("begin")).select(
        "path", "begin", F.least(F.col("begin") + range_bytes, F.col("length")).alias("finish"))


def counted(ranges: DataFrame) -> DataFrame:
    """Quotes of each range, and how much deeper it ends if it begins outside or inside a string."""
    opened, tools, schema = opener(), range_reader(), COUNTED

    def read(batches):
        import numpy as np
        import pandas as pd

        part, backslashes_before, unescaped_quotes, brackets, utf8, _ = tools
        names = [x.split()[0] for x in schema.split(", ")]
        for batch in batches:
            rows = []
            for path, begin, finish in zip(batch["path"], batch["begin"], batch["finish"]):
                with opened(path) as file:
                    before = backslashes_before(file, begin)
                    raw = part(file, begin, finish)
                data = np.frombuffer(raw, np.uint8)
                quotes = unescaped_quotes(data, before)
                depths = [int(brackets(data, quotes, state).sum()) for state in (0, 1)]
                rows.append((path, begin, finish, int(quotes.sum()), *depths, utf8(raw)))
            yield pd.DataFrame(rows, columns=names)

    return ranges.mapInPandas(read, schema)


def states(counts: DataFrame) -> DataFrame:
    """Every range with whether it begins in a string, and at what depth; and the file's verdict."""
    before = Window.partitionBy("path").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("path")
    known = counts.withColumn("in_string", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    known = known.withColumn("deeper", F.when(F.col("in_string") == 1, F.col("inside")).otherwise(F.col("outside")))
    known = known.withColumn("depth", F.coalesce(F.sum("deeper").over(before), F.lit(0)))
    closed = (F.sum("quotes").over(whole) % 2 == 0) & (F.sum("deeper").over(whole) == 0) & (F.min(F.col("depth")).over(whole) >= 0)
    issue = F.when(~F.bool_and("utf8").over(whole), NOT_UTF8).when(~closed, BROKEN_ANSWER)
    return known.select("path", "begin", "finish", "in_string", "depth", issue.alias("issue"))


def events(known: DataFrame, outer: str, inner: str) -> DataFrame:
    """Where `outer` and, in it, `inner` open (kinds 1 and 2), and the next places after a range's
    begin or such an opening where its level is closed again (kinds -1 and -2) or an element may
    start (kind 3)."""
    opened, tools, schema, wanted = opener(), range_reader(), EVENTS, {1: (outer, 123), 2: (inner, 91)}

    def read(batches):
        import json

        import numpy as np
        import pandas as pd

        part, backslashes_before, unescaped_quotes, brackets, _, key_before = tools
        names = [x.split()[0] for x in schema.split(", ")]
        for batch in batches:
            rows = []
            for path, begin, finish, in_string, depth in zip(*(batch[c] for c in ("path", "begin", "finish", "in_string", "depth"))):
                with opened(path) as file:
                    before = backslashes_before(file, begin)
                    data = np.frombuffer(part(file, begin, finish), np.uint8)
                    change = brackets(data, unescaped_quotes(data, before), in_string)
                    after = depth + np.cumsum(change)
                    for level, (name, bracket) in wanted.items():
                        opens = []
                        for at in np.flatnonzero((change == 1) & (after == level + 1) & (data == bracket)).tolist():
                            key = key_before(file, begin + at)
                            try:
                                named = key is not None and json.loads(b'"' + key + b'"') == name
                            except ValueError:
                                named = False
                            if named:
                                opens.append(at)
                        closes = np.flatnonzero((change == -1) & (after == level))
                        ends = {int(closes[i]) for i in np.searchsorted(closes, [0, *opens]) if i < len(closes)}
                        rows += [(path, begin + at, level) for at in opens] + [(path, begin + at, -level) for at in ends]
                    objects = np.flatnonzero((change == 1) & (after == 4) & (data == 123))
                    firsts = {int(objects[i]) for i in np.searchsorted(objects, [0, *opens]) if i < len(objects)}
                    rows += [(path, begin + at, 3) for at in firsts]
            yield pd.DataFrame(rows, columns=names)

    return known.select("path", "begin", "finish", "in_string", "depth").mapInPandas(read, schema)


def intervals(found: DataFrame) -> DataFrame:
    """`path`, and the places of the brackets around the array; of repeated names the last counts."""
    rest = Window.partitionBy("path").orderBy("at", F.desc("kind")).rowsBetween(1, Window.unboundedFollowing)
    closed = found.select("path", "at", "kind", *[
        F.min(F.when(F.col("kind") == -level, F.col("at"))).over(rest).alias(f"end{level}") for level in (1, 2)])
    outer = closed.filter("kind = 1").groupBy("path").agg(F.max_by(F.struct("at", "end1"), "at").alias("o"))
    inner = closed.filter("kind = 2").join(outer, "path").filter((F.col("at") > F.col("o.at")) & (F.col("at") < F.col("o.end1")))
    return inner.groupBy("path").agg(F.max_by(F.struct("at", "end2"), "at").alias("i")).select(
        "path", F.col("i.at").alias("opening"), F.col("i.end2").alias("closing"))


def elements(known: DataFrame, batch_bytes: int = RANGE_BYTES) -> DataFrame:
    """Objects of the array between `opening` and `closing` that start in each range."""
    opened, tools, schema = opener(), range_reader(), ELEMENTS

    def read(batches):
        import numpy as np
        import pandas as pd

        part, backslashes_before, unescaped_quotes, brackets, _, _ = tools
        names = [x.split()[0] for x in schema.split(", ")]

        def rest(file, at, in_string, depth, level, step):
            """Bytes from a place to where the depth falls back to a level."""
            out = []
            while step:
                raw = part(file, at, at + step)
                data = np.frombuffer(raw, np.uint8)
                quotes = unescaped_quotes(data, backslashes_before(file, at))
                after = depth + np.cumsum(brackets(data, quotes, in_string))
                ends = np.flatnonzero(after == level)
                if len(ends) or not raw:
                    out.append(raw[:int(ends[0]) + 1] if len(ends) else b"")
                    break
                out.append(raw)
                at, depth, in_string = at + len(raw), int(after[-1]), (in_string + int(quotes.sum())) % 2
            return b"".join(out)

        for batch in batches:
            columns = ("path", "begin", "finish", "in_string", "depth", "opening", "closing")
            for path, begin, finish, in_string, depth, opening, closing in zip(*(batch[c] for c in columns)):
                rows, size = [], 0
                with opened(path) as file:
                    before = backslashes_before(file, begin)
                    raw = part(file, begin, finish)
                    data = np.frombuffer(raw, np.uint8)
                    quotes = unescaped_quotes(data, before)
                    change = brackets(data, quotes, in_string)
                    after = depth + np.cumsum(change)
                    level = 3
                    starts = np.flatnonzero((change == 1) & (after == level + 1) & (data == 123))
                    starts = starts[(starts + begin > opening) & (starts + begin < closing)]
                    closes = np.flatnonzero((change == -1) & (after == level))
                    for at, end in zip(starts.tolist(), np.searchsorted(closes, starts).tolist()):
                        if end < len(closes):
                            text = raw[at:int(closes[end]) + 1]
                        else:
                            state = (in_string + int(quotes.sum())) % 2
                            text = raw[at:] + rest(file, finish, state, int(after[-1]), level, max(finish - begin, 4096))
                        rows.append((path, begin + at, text.decode("utf-8")))
                        size += len(text)
                        if size > batch_bytes:
                            yield pd.DataFrame(rows, columns=names)
                            rows, size = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    return known.mapInPandas(read, schema)


def array_elements(files: DataFrame, outer: str = "data", inner: str = "items", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """`path, at, element, issue` for the objects of `outer.inner[]` in files of `path` and `length`.

    A file that is not UTF-8, whose brackets or strings do not close, or that has no such objects
    is one row without an element. Entries of the array that are no objects are passed over.
    """
    total = files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    if not total:
        empty = files.filter(F.lit(False))
        return empty.select("path", F.lit(0).cast("bigint").alias("at"), F.lit("").alias("element"), F.lit("").alias("issue"))
    # A row per range, taken from one pass and used by the two others; these deal the ranges anew,
    # as prefix sums bring a file's rows together.
    ensure_checkpoint_dir(files.sparkSession)
    known = states(counted(dealt(ranges_of(files, range_bytes), total, "path", "begin"))).checkpoint()
    sound = known.filter(F.col("issue").isNull())
    seen = events(dealt(sound, total, "path", "begin"), outer, inner).checkpoint()
    places = intervals(seen).checkpoint()
    filled = seen.filter("kind = 3").join(places, "path").filter(F.col("at").between(F.col("opening"), F.col("closing")))
    within = sound.join(places, "path").filter((F.col("finish") > F.col("opening")) & (F.col("begin") < F.col("closing")))
    found = elements(dealt(within.select("path", "begin", "finish", "in_string", "depth", "opening", "closing"), total, "path", "begin"))
    named = found.select("path", "at", "element", F.lit(None).cast("string").alias("issue"))
    verdicts = known.groupBy("path").agg(F.first("issue").alias("issue"))
    none = verdicts.join(filled.select("path").distinct(), "path", "left_anti")
    return named.unionByName(none.select(
        "path", F.lit(0).cast("bigint").alias("at"), F.lit(None).cast("string").alias("element"), F.coalesce("issue", F.lit(NO_ITEMS)).alias("issue")))
