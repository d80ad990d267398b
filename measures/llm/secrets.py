"""Secrets in texts: fixed patterns, and windows of high entropy.

DataFrame functions only: every row is scanned by itself, nothing is shuffled
and no Python runs in tasks.

* Patterns: each kind's matches are leftmost and do not overlap; places follow
  from the pieces between matches, in code points.
* Entropy: for each character class, every maximal run of at least a window's
  characters is a candidate.  A window slides over it; the counts of its
  characters are kept as one short string with a digit per character of the
  class, so that a step changes two counts and the sum of c*log2(c) by two
  table entries, in integers.  Windows of enough entropy are merged to spans.
  A span is suppressed when an allow-list pattern matches it, or the whole
  candidate.

A null text is empty; empty texts, and tables, give no spans.  Texts of any
length are scanned whole; their matches' places are summed in blocks, so the
work grows with the length.  Rows are taken one by one, so repeated rows (and
rows that share an id, or have none) each give their own result.  Two spans at
one place are ordered by kind, then end.  Only the two named columns are read:
others may have any names.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The contract's kinds.  A hex or access match is a maximal run,
# so its least length stands in the pattern; a short assignment is dropped after
# the match, since it hides what it covers.
ASSIGN = (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
          r"([A-Za-z0-9+/_.=-]+)")
ASSIGN_LEAST = 6
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
# End of fixed values.

BLOCK = 256  # places summed before a block of them is put aside


@dataclass(frozen=True)
class CharClass:
    """Characters whose runs are scanned, the window, and the least entropy in
    bits a character.  `fold` counts both cases of a letter as one."""

    kind: str
    alphabet: str
    window: int
    bits: float
    fold: bool = False

    @property
    def members(self) -> str:
        both = self.alphabet + (self.alphabet.upper() if self.fold else "")
        return "".join(sorted({c if c.isalnum() else "\\" + c for c in both}))

    @property
    def pattern(self) -> str:
        return f"(?<![{self.members}])[{self.members}]{{{self.window},}}+"

    @property
    def most(self) -> int:
        """The greatest sum of c*log2(c) (in millionths) that is entropy enough."""
        return math.floor(1e6 * self.window * (math.log2(self.window) - self.bits))


LETTERS = "abcdefghijklmnopqrstuvwxyz"
HEX_CLASS = CharClass("entropy_hex", "0123456789abcdef", 20, 3.0, fold=True)
BASE64_CLASS = CharClass("entropy_base64", "0123456789" + LETTERS.upper() + LETTERS + "+/=_-", 24, 4.0)
CLASSES = (HEX_CLASS, BASE64_CLASS)

# Allow-list.  WHOLE is held against the candidate, PART against the span.
ALLOW_WHOLE = (
    r"^[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",  # a UUID
    r"^d41d8cd98f00b204e9800998ecf8427e$",  # digests of nothing
    r"^da39a3ee5e6b4b0d3255bfef95601890afd80709$",
    r"^e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855$",
    r"^[0-9]+$",  # plain numbers
)
ALLOW_PART = (
    r"^[^0-9]*$",  # words, paths and names without a digit
    r"(?i)example|sample|placeholder|changeme|dummy",
    r"(?i)abcdefghij|0123456789|qwertyuiop",
)

BASE_KINDS = ("assign", "access", "hex")
PLACES = "array<struct<start:bigint,end:bigint,text:string>>"


def counted(n: int) -> int:
    """c*log2(c) in millionths."""
    return round(1e6 * n * math.log2(n)) if n else 0


def _let(value: Column, body) -> Column:
    """body(value), with value worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _no_places() -> Column:
    return F.array().cast(PLACES)


def find_all(text: Column, pattern: str) -> Column:
    """Every match of `pattern` with its start and end in code points."""
    def place(found: Column) -> Column:
        parts = F.slice(F.zip_with(
            F.split(text, pattern, -1), found,
            lambda gap, match: F.struct(F.char_length(gap).cast("bigint").alias("gap"),
                                        F.char_length(match).cast("bigint").alias("n"),
                                        match.alias("text"))), F.lit(1), F.size(found))

        def step(s: Column, x: Column) -> Column:
            start = s["at"] + x["gap"]
            new = F.array(F.struct(start.alias("start"), (start + x["n"]).alias("end"),
                                   x["text"].alias("text")))
            full = F.size(s["block"]) >= BLOCK
            return F.struct(
                (start + x["n"]).alias("at"),
                F.when(full, new).otherwise(F.concat(s["block"], new)).alias("block"),
                F.when(full, F.concat(s["done"], F.array(s["block"]))).otherwise(s["done"])
                .alias("done"))

        return F.aggregate(
            parts, F.struct(F.lit(0).cast("bigint").alias("at"), _no_places().alias("block"),
                            F.array().cast(f"array<{PLACES}>").alias("done")),
            step, lambda s: F.concat(F.flatten(s["done"]), s["block"]))

    return _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                lambda found: F.when(F.size(found) > 0, place(found)).otherwise(_no_places()))


def _count_at(counts: Column, k: Column) -> Column:
    return F.ascii(F.substring(counts, k, F.lit(1))) - 48


def _with_count(counts: Column, k: Column, n: Column) -> Column:
    return F.overlay(counts, F.char(n + 48), k, F.lit(1))


def high_windows(run: Column, kind: CharClass) -> Column:
    """Merged windows of `run` with enough entropy: array of (start, end)."""
    w = kind.window
    table = F.array(*[F.lit(counted(c)).cast("bigint") for c in range(w + 2)])
    value = lambda c: F.get(table, c)
    letters = F.transform(F.split(F.lower(run) if kind.fold else run, ""),
                          lambda ch: F.instr(F.lit(kind.alphabet), ch))

    def slide(codes: Column) -> Column:
        def moved(s: Column, i: Column) -> Column:
            """Counts and their sum after the i-th character has come in."""
            come, gone = F.get(codes, i), F.get(codes, i - w)
            n_come, n_gone = _count_at(s["counts"], come), _count_at(s["counts"], gone)
            rise = value(n_come + 1) - value(n_come)
            fall = value(n_gone) - value(n_gone - 1)
            return (F.when(i < w, F.struct(
                        _with_count(s["counts"], come, n_come + 1).alias("counts"),
                        (s["sum"] + rise).alias("sum")))
                    .when(come == gone, F.struct(s["counts"].alias("counts"), s["sum"].alias("sum")))
                    .otherwise(F.struct(
                        _with_count(_with_count(s["counts"], gone, n_gone - 1), come, n_come + 1)
                        .alias("counts"), (s["sum"] + rise - fall).alias("sum"))))

        def step(s: Column, i: Column) -> Column:
            def after(m: Column) -> Column:
                hot = (i >= w - 1) & (m["sum"] <= kind.most)
                first = i - (w - 1)
                apart = hot & (first > s["end"])
                done = F.concat(s["done"], F.array(F.struct(
                    s["start"].alias("start"), s["end"].alias("end"))))
                return F.struct(
                    m["counts"].alias("counts"), m["sum"].alias("sum"),
                    F.when(apart, first).otherwise(s["start"]).alias("start"),
                    F.when(hot, i + 1).otherwise(s["end"]).alias("end"),
                    F.when(apart & (s["end"] >= 0), done).otherwise(s["done"]).alias("done"))
            return _let(moved(s, i), after)

        return F.aggregate(
            F.sequence(F.lit(0), F.size(codes) - 1),
            F.struct(F.lit("0" * len(kind.alphabet)).alias("counts"),
                     F.lit(0).cast("bigint").alias("sum"), F.lit(-1).alias("start"),
                     F.lit(-1).alias("end"),
                     F.array().cast("array<struct<start:int,end:int>>").alias("done")),
            step, lambda s: F.when(s["end"] >= 0, F.concat(s["done"], F.array(F.struct(
                s["start"].alias("start"), s["end"].alias("end"))))).otherwise(s["done"]))

    return _let(letters, slide)


def _allowed(text: Column, patterns) -> Column:
    out = F.lit(False)
    for p in patterns:
        out = out | text.rlike(p)
    return out


def _as_spans(places: Column, number: int) -> Column:
    return F.transform(places, lambda p: F.struct(
        p["start"].alias("start"), F.lit(number).alias("kind"), p["end"].alias("end")))


def base_spans(text: Column) -> Column:
    """The contract's matches as (start, kind number, end)."""
    assign = F.filter(find_all(text, ASSIGN), lambda p: F.char_length(
        F.regexp_extract(p["text"], ASSIGN, 2)) >= ASSIGN_LEAST)
    return F.concat(_as_spans(assign, 0), _as_spans(find_all(text, ACCESS), 1),
                    _as_spans(find_all(text, HEX), 2))


def entropy_spans(text: Column, kind: CharClass, number: int, allow_whole=ALLOW_WHOLE,
                  allow_part=ALLOW_PART) -> Column:
    runs = F.filter(find_all(text, kind.pattern), lambda p: ~_allowed(p["text"], allow_whole))
    spans = F.transform(runs, lambda p: F.transform(
        F.filter(high_windows(p["text"], kind), lambda h: ~_allowed(
            F.substring(p["text"], h["start"] + 1, h["end"] - h["start"]), allow_part)),
        lambda h: F.struct((p["start"] + h["start"]).alias("start"), F.lit(number).alias("kind"),
                           (p["start"] + h["end"]).alias("end"))))
    return F.flatten(spans)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 classes=CLASSES, allow_whole=ALLOW_WHOLE, allow_part=ALLOW_PART) -> DataFrame:
    """One row per document: id, `base` (spans of the fixed patterns) and
    `added` (spans of high entropy), each an array of (start, kind, end) in
    order of start, kind, end."""
    kinds = F.array(*[F.lit(k) for k in (*BASE_KINDS, *(c.kind for c in classes))])
    named = lambda spans: F.transform(F.array_sort(spans), lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("number"),
        F.get(kinds, s["kind"]).alias("kind"), s["end"].alias("end")))
    text = F.col("text")
    added = [entropy_spans(text, c, len(BASE_KINDS) + i, allow_whole, allow_part)
             for i, c in enumerate(classes)]
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    return docs.select(F.col(id_col).alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text")).select(
        "id", named(base_spans(text)).alias("base"), named(F.concat(none, *added)).alias("added"))


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def in_order(spans: Column) -> Column:
    """Spans by start, then kind as listed, then end."""
    return F.array_sort(spans)


def oracle_sql(classes=CLASSES) -> str:
    """The contract and the default scan over `documents` in plain SQL: every
    window of every candidate is counted anew."""
    either = lambda s: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in s)
    words = "|".join(either(x) for x in ("password", "passwd", "secret", "token")) \
        + "|" + either("api") + "_?" + either("key")
    assign = f"""(?:{words})["']?\\x20*[:=]\\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    allowed = lambda col, ps: " OR ".join(
        f"regexp_matches({col}, {quoted(p)})" for p in ps)
    kinds = [("assign", assign), ("access", "AKIA[A-Z0-9]+"), ("hex", "[0-9a-f]+"),
             *((c.kind, f"[{c.members}]+") for c in classes)]
    pieces = "\nUNION ALL ".join(
        f"SELECT doc_id, {i} AS n, regexp_extract_all(text, {quoted(p)}) AS found, "
        f"regexp_split_to_array(text, {quoted(p)}) AS gaps FROM texts"
        for i, (_, p) in enumerate(kinds))
    values = lambda rows: ", ".join(
        "(" + ", ".join(str(v) if not isinstance(v, str) else quoted(v) for v in r) + ")"
        for r in rows)
    wide = max(c.window for c in classes)
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
kinds(n, kind) AS (VALUES {values(list(enumerate(k for k, _ in kinds)))}),
classes(n, w, most, fold) AS (VALUES {values([(len(BASE_KINDS) + i, c.window, c.most, c.fold) for i, c in enumerate(classes)])}),
worth(c, v) AS (VALUES {values([(c, counted(c)) for c in range(1, wide + 1)])}),
pieces AS ({pieces}),
matches AS (
  SELECT doc_id, n, found[i] AS word, i, length(gaps[i]) AS gap, length(found[i]) AS size
  FROM (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM pieces)),
placed AS (
  SELECT doc_id, n, word, size,
         sum(gap + size) OVER (PARTITION BY doc_id, n ORDER BY i) - size AS start
  FROM matches),
base AS (
  SELECT doc_id, n, start::BIGINT AS start, (start + size)::BIGINT AS stop FROM placed
  WHERE n = 0 AND length(regexp_extract(word, {quoted(assign)}, 1)) >= {ASSIGN_LEAST}
     OR n = 1 AND size >= 20 OR n = 2 AND size >= 24),
runs AS (
  SELECT placed.*, w, most, fold, row_number() OVER () AS run FROM placed JOIN classes USING (n)
  WHERE size >= w AND NOT ({allowed('word', ALLOW_WHOLE)})),
windows AS (
  SELECT run, n, w, most, pos, CASE WHEN fold THEN lower(word[pos:pos + w - 1]) ELSE word[pos:pos + w - 1] END AS part
  FROM (SELECT *, unnest(range(1, size - w + 2)) AS pos FROM runs)),
counted AS (
  SELECT run, pos, any_value(w) AS w, any_value(most) AS most, letter, count(*) AS c
  FROM (SELECT run, pos, w, most, unnest(string_split(part, '')) AS letter FROM windows)
  GROUP BY run, pos, letter),
hot AS (
  SELECT run, pos, any_value(w) AS w FROM counted JOIN worth USING (c)
  GROUP BY run, pos HAVING sum(v) <= any_value(most)),
cuts AS (
  SELECT *, CASE WHEN pos > lag(pos) OVER (PARTITION BY run ORDER BY pos) + w THEN 1 ELSE 0 END AS cut
  FROM hot),
merged AS (
  SELECT run, min(pos) AS first, max(pos + w) AS past
  FROM (SELECT *, sum(cut) OVER (PARTITION BY run ORDER BY pos) AS part FROM cuts) GROUP BY run, part),
added AS (
  SELECT doc_id, n, (start + first - 1)::BIGINT AS start, (start + past - 1)::BIGINT AS stop
  FROM (SELECT runs.*, first, past, word[first:past - 1] AS span FROM merged JOIN runs USING (run))
  WHERE NOT ({allowed('span', ALLOW_PART)})),
spans AS (SELECT *, true AS basic FROM base UNION ALL SELECT *, false FROM added),
texts_of AS (
  SELECT doc_id, count(*) FILTER (n = 0) AS n_assign, count(*) FILTER (n = 1) AS n_access,
         count(*) FILTER (n = 2) AS n_hex,
         string_agg(name, ',' ORDER BY start, n, stop) FILTER (basic) AS names,
         string_agg(name, ',' ORDER BY start, n, stop) AS all_names
  FROM (SELECT *, kind || ':' || start || ':' || stop AS name FROM spans JOIN kinds USING (n))
  GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(names, '')) AS base_sha256,
       coalesce(all_names, '') AS spans
FROM texts LEFT JOIN texts_of USING (doc_id)
"""
