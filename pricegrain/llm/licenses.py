"""Licence scans by a positional index of rare words, in DataFrame functions only.

Each template has a mandatory key phrase. The corpus's own document frequencies name the rarest words of
every phrase; the index maps such a word to (template, place in the phrase). One pass over a file's words lists the
places of all index words, if it has those of a whole phrase at all; most haven't. From these postings alone each phrase gets the starts that its rarest
words imply, so that a file's cost doesn't grow with the number of templates; starts that all agree on are
candidates, and the whole phrase is verified there. The score weighs how much of the template stands
around the phrase, by inverse document frequency.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrase: str
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def key(self) -> list[str]:
        return self.phrase.split()

    @property
    def offset(self) -> int:
        """Words of the template before its phrase."""
        return len(self.text[: self.text.index(self.phrase)].split())


TEMPLATES = (
    Template("mit", "released under the mit license", "under the mit license", True),
    Template("apache-2", "licensed under the apache license version 2 0", "apache license version 2", True),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc", True),
    Template("gpl-3", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    Template("gpl-2", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    Template("mpl-2", "subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification", "redistribution and use in source and binary forms"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy", "permission is hereby granted free of charge"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template("agpl-3", "licensed under the gnu affero general public license version 3", "gnu affero general public license version 3"),
    Template("lgpl", "redistribute it and or modify it under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    Template("epl-2", "made available under the terms of the eclipse public license v 2 0", "eclipse public license v 2"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "with or without fee is hereby granted"),
    Template("zlib", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software", "altered source versions must be plainly marked"),
    Template("cc0-1", "dedicated to the public domain under cc0 1 0 universal", "cc0 1 0 universal"),
    Template("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
)
VOCABULARY = sorted({w for t in TEMPLATES for w in t.words})


def words(text_col: str = "text") -> Column:
    """Words of a text with A-Z in lower case; null texts have none."""
    low = F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(low, F.lit(WORD), F.lit(0))


def strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def inverse_frequencies(docs: DataFrame, text_col: str = "text") -> dict[str, float]:
    """ln((1 + documents) / (1 + documents with the word)) of every template word, over all documents."""
    seen = docs.select(F.explode(F.array_append(F.array_intersect(words(text_col), strings(VOCABULARY)), F.lit(" "))).alias("w"))
    count = {r["w"]: r["count"] for r in seen.groupBy("w").count().collect()}  # at most a row for each template word
    n = count.pop(" ", 0)
    return {w: math.log((1 + n) / (1 + count.get(w, 0))) for w in VOCABULARY}


def _listing(index: list[list[str]]) -> Column:
    """Postings (word, place) of the index words of a file, in order; null if it has no phrase's words all."""
    every = sorted({w for own in index for w in own})
    posted = F.transform("_words", lambda w, p: F.when(w.isin(*every), F.struct(w.alias("word"), p.alias("place"))))
    complete = F.lit(False)
    for own in index:
        complete |= F.size(F.array_intersect("_hit", strings(own))) == len(own)
    return F.when(complete, F.filter(posted, lambda x: x.isNotNull()))


def _postings(word: str, place: int) -> Column:
    """Phrase starts that a word's places imply if it stands at ``place`` of the phrase."""
    own = F.filter("_posted", lambda x: (x["word"] == word) & (x["place"] >= place))
    return F.transform(own, lambda x: x["place"] - place)


def _places(t: Template, index: list[str]) -> Column:
    """Starts of the phrase of ``t``: those on which the postings of its rarest words agree, verified in full."""
    starts = None
    for word in index:
        own = [_postings(word, place) for place, other in enumerate(t.key) if other == word]
        implied = own[0] if len(own) == 1 else F.array_distinct(F.flatten(F.array(*own)))
        starts = implied if starts is None else F.array_intersect(starts, implied)
    verified = F.filter(starts, lambda s: F.slice(F.col("_words"), s + 1, len(t.key)) == strings(t.key))
    return F.when(F.col("_posted").isNotNull() & (F.size(starts) > 0), verified).otherwise(F.array().cast("array<int>"))


def _grade(t: Template, idf: dict[str, float]):
    """Share of the template's weight that stands around a place of its phrase."""
    whole = sum(idf[x] for x in t.words)

    def of(s):
        total = F.lit(0.0)
        for j, x in enumerate(t.words):
            at = s + (j - t.offset)
            total = total + F.when(F.when(at >= 0, F.coalesce(F.get(F.col("_words"), at) == x, F.lit(False))).otherwise(False), idf[x]).otherwise(0.0)
        return total / whole if whole else F.lit(1.0)

    return of


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, rare: int = 2) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row.

    Null and empty texts have no words and score 0; texts of any length are scanned whole; rows that
    repeat come back as often as they came; an empty table gives an empty one; other columns are ignored.
    """
    idf = inverse_frequencies(docs, text_col)
    index = [sorted({*t.key}, key=lambda x: (-idf[x], x))[:rare] for t in templates]
    frame = docs.select(F.col(id_col).alias(id_col), words(text_col).alias("_words"))
    frame = frame.withColumn("_hit", F.array_intersect("_words", strings(sorted({w for own in index for w in own})))).withColumn("_posted", _listing(index))
    places, quality = [], []
    for i, t in enumerate(templates):
        frame = frame.withColumn(f"_at{i}", _places(t, index[i]))
        places.append(F.col(f"_at{i}"))
        quality.append(F.coalesce(F.array_max(F.transform(F.col(f"_at{i}"), _grade(t, idf))), F.lit(0.0)))
    joined = lambda some: F.array_join(F.array_sort(F.array_distinct(F.filter(F.array(*[F.when(F.size(p) > 0, t.label) for t, p in some]), lambda x: x.isNotNull()))), ",")
    both = list(zip(templates, places))
    base = [(t, p) for t, p in both if t.base]
    every = F.concat(*[p for _, p in base])
    return frame.select(
        id_col,
        F.size("_words").cast("long").alias("n_words"),
        F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"),
        F.array_max(every).cast("long").alias("last_word"),
        joined(base).alias("base_labels"),
        joined(both).alias("labels"),
        F.round(F.greatest(*quality), 9).alias("score"),
    )


def sql(templates=TEMPLATES) -> str:
    """The same in DuckDB SQL, for the table ``documents``."""
    listed = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]"
    at = ",\n  ".join(f"CASE WHEN list_has_all(w, {listed(t.key)}) THEN list_filter(range(0, greatest(len(w) - {len(t.key) - 1}, 0)), lambda s: w[s + 1 : s + {len(t.key)}] = {listed(t.key)}) ELSE []::bigint[] END AS p{i}" for i, t in enumerate(templates))
    grade = []
    for i, t in enumerate(templates):
        total = " + ".join(["0.0::double", *[f"CASE WHEN s + {j - t.offset} >= 0 AND w[s + {j - t.offset + 1}] = '{x}' THEN idf['{x}'] ELSE 0.0::double END" for j, x in enumerate(t.words)]])
        whole = " + ".join(f"idf['{x}']" for x in t.words)
        grade.append(f"coalesce(list_max(list_transform(p{i}, lambda s: ({total}) / ({whole}))), 0.0)")
    base = [(i, t) for i, t in enumerate(templates) if t.base]
    joined = lambda some: "array_to_string(list_sort(list_distinct(list_filter([" + ", ".join(f"CASE WHEN len(p{i}) > 0 THEN '{t.label}' END" for i, t in some) + "], lambda x: x IS NOT NULL))), ',')"
    every = "list_concat(" * (len(base) - 1) + f"p{base[0][0]}" + "".join(f", p{i})" for i, _ in base[1:])
    return f"""
WITH split AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
held AS (SELECT v.word, ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + (SELECT count(*) FROM split WHERE list_contains(w, v.word)))) AS value FROM (SELECT unnest({listed(VOCABULARY)}) AS word) v),
weights AS (SELECT map_from_entries(list({{'k': word, 'v': value}})) AS idf FROM held),
found AS (SELECT doc_id, w, idf,
  {at}
FROM split, weights)
SELECT doc_id, len(w)::bigint AS n_words, len({every})::bigint AS n_base, list_min({every})::bigint AS first_word, list_max({every})::bigint AS last_word,
  {joined(base)} AS base_labels, {joined(list(enumerate(templates)))} AS labels, round(greatest({", ".join(grade)}), 9) AS score
FROM found"""
