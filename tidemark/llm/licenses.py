"""Licence scan by a positional index of rare words.

Licence templates are word sequences. For each file the places of licence words are kept (all others are
dropped at once), and their document frequencies over all files give IDF weights. Each place of a template's
words proposes where the template begins. A proposal is compared with the template's postings by relative
position: the share of the template's IDF weight found at its places is its cover. A template's label is given
where its cover is high enough and its key phrase stands word for word.

Rare words propose first: so many, by falling IDF, that the others weigh less than ``1 - COVER`` of the
template. A place with a cover of ``COVER`` or more holds one of them, so where they find such a cover it is
the greatest. Otherwise all words of the template propose.

The base phrases are templates that must stand whole. All their words are licence words, so a phrase stands
at consecutive entries of a file's index and every place of it is found by its rarest word.

Only built-in functions are used; texts are never shuffled, and the words counted for IDF are those of the
templates.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import written

# Phrases whose every place counts, with their labels.
BASE = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]
# Label, template and key phrase, from the public licence texts, in lower-case words.
TEXTS = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted free of charge"),
    ("apache-2", "licensed under the apache license version 2 0 you may not use this file except in compliance with the license", "apache license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license", "gnu general public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "permission to use copy modify and or distribute this software"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("cc-by", "this work is licensed under a creative commons attribution license", "creative commons attribution license"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", "creative commons attribution 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 3 0 unported license", "creative commons attribution 3 0"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial license", "attribution noncommercial"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license", "creative commons attribution sharealike"),
    ("cc-by-nd", "this work is licensed under a creative commons attribution noderivatives 4 0 international license", "creative commons attribution noderivatives"),
    ("cc0", "has dedicated all copyright and related and neighboring rights to this software to the public domain worldwide", "related and neighboring rights"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
    ("lgpl", "you can redistribute it and or modify it under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    ("lgpl", "you can redistribute it and or modify it under the terms of the gnu library general public license", "gnu library general public license"),
    ("agpl-3", "you can redistribute it and or modify it under the terms of the gnu affero general public license", "gnu affero general public license"),
    ("gfdl", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license", "gnu free documentation license"),
    ("bsd-3", "may be used to endorse or promote products derived from this software without specific prior written permission", "may be used to endorse or promote products"),
    ("bsd-4", "all advertising materials mentioning features or use of this software must display the following acknowledgement", "all advertising materials mentioning features"),
    ("zlib", "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely", "permission is granted to anyone to use this software"),
    ("postgresql", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted", "without a written agreement"),
    ("upl-1", "permission is hereby granted to any person obtaining a copy of this software associated documentation and or data", "associated documentation and or data"),
    ("mpl-1", "the contents of this file are subject to the mozilla public license version 1 1", "mozilla public license version 1"),
    ("epl-1", "are made available under the terms of the eclipse public license v1 0 which accompanies this distribution", "eclipse public license v1"),
    ("epl-2", "are made available under the terms of the eclipse public license 2 0 which is available at", "eclipse public license 2"),
    ("cddl", "the contents of this file are subject to the terms of the common development and distribution license", "common development and distribution license"),
    ("eupl", "licensed under the eupl you may not use this work except in compliance with the licence", "under the eupl"),
    ("ecl-2", "licensed under the educational community license version 2 0 you may not use this file except in compliance with the license", "educational community license"),
    ("afl-3", "licensed under the academic free license version 3 0", "academic free license version 3"),
    ("osl-3", "licensed under the open software license version 3 0", "open software license version 3"),
    ("ofl", "this font software is licensed under the sil open font license version 1 1", "sil open font license"),
    ("odbl", "this database is made available under the open database license", "open database license"),
    ("lppl", "this work may be distributed and or modified under the conditions of the latex project public license", "latex project public license"),
    ("artistic-2", "you may distribute your modified version as source either gratis or for a distributor fee", "for a distributor fee"),
    ("wtfpl", "everyone is permitted to copy and distribute verbatim or modified copies of this license document", "verbatim or modified copies of this license document"),
    ("cecill", "this software is governed by the cecill license under french law and abiding by the rules of distribution of free software", "the cecill license"),
    ("openssl", "this product includes software developed by the openssl project for use in the openssl toolkit", "for use in the openssl toolkit"),
    ("psf", "psf is making python available to licensee on an as is basis", "psf is making python available"),
    ("mulan-2", "you can use this software according to the terms and conditions of the mulan psl v2", "mulan psl v2"),
]
# Labels and the identifiers that a one-line notice gives for them.
IDENTIFIERS = [
    ("mit", "MIT"), ("apache-2", "Apache-2.0"), ("bsd", "BSD-2-Clause"), ("bsd-3", "BSD-3-Clause"), ("gpl", "GPL-2.0"), ("gpl", "GPL-3.0"),
    ("lgpl", "LGPL-2.1"), ("lgpl", "LGPL-3.0"), ("agpl-3", "AGPL-3.0"), ("mpl-2", "MPL-2.0"), ("epl-2", "EPL-2.0"), ("isc", "ISC"),
    ("unlicense", "Unlicense"), ("cc0", "CC0-1.0"), ("cc-by", "CC-BY-4.0"), ("cc-by-sa", "CC-BY-SA-4.0"), ("cc-by-nc", "CC-BY-NC-4.0"),
]


def _notice(identifier: str) -> str:
    return " ".join(["spdx license identifier", *identifier.lower().replace(".", "-").split("-")])


#: An identifier's notice must stand whole, so it is its own key phrase.
TEMPLATES = TEXTS + [(label, _notice(name), _notice(name)) for label, name in IDENTIFIERS]
#: Least share of a template's IDF weight for its label.
COVER = 0.6
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text with A-Z lower-cased; NULL has none.

    ``lower`` also changes other letters, which no licence word has; of these only the Kelvin sign and the
    dotted capital I would become ASCII letters, so they are replaced by other letters first.
    """
    plain = F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("ĸ")), F.lit("İ"), F.lit("ı"))
    return F.regexp_extract_all(F.lower(plain), F.lit(f"({WORD})"), F.lit(0))


def licence_words() -> list[str]:
    phrases = [p for _, p in BASE] + [t for _, text, key in TEMPLATES for t in (text, key)]
    return sorted({w for p in phrases for w in p.split()})


def indexed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, n_words, hits)``: of each row its licence words with their positions, in order."""
    listed = docs.select(F.col(id_col).alias("doc_id"), words(F.col(text_col)).alias("words"))
    placed = F.transform("words", lambda w, i: F.struct(w.alias("word"), i.alias("at")))
    return listed.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.filter(placed, lambda h: h["word"].isin(licence_words())).alias("hits"),
    )


def inverse_frequencies(index: DataFrame) -> dict[str, float]:
    """IDF of every licence word over all files; as many rows as there are licence words."""
    held = index.select(F.explode(F.array_distinct(F.transform("hits", lambda h: h["word"]))).alias("word"))
    files = index.count()
    counts = dict(held.groupBy("word").agg(F.count(F.lit(1))).collect())
    return {w: math.log(1.0 + (files + 1) / (counts.get(w, 0) + 0.5)) for w in licence_words()}


def _array(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _anchor(phrase: list[str], needed: list[str], idf: dict[str, float]) -> Column:
    """The highest-IDF word of the phrase that the file holds; NULL if it lacks one of the needed words."""
    by_rarity = sorted(set(phrase), key=lambda w: (-idf[w], w))
    lacks = F.size(F.array_except(_array(sorted(set(needed))), F.col("held")))
    return F.when(lacks == 0, F.get(F.array_intersect(_array(by_rarity), F.col("held")), F.lit(0)))


def _heavy(phrase: list[str], idf: dict[str, float]) -> list[str]:
    """Words of the highest IDF, without which less than ``1 - COVER`` of the phrase's IDF weight is left."""
    left, out = sum(idf[w] for w in phrase), []
    most = (1 - COVER) * left * (1 - 1e-9)
    for w in sorted(set(phrase), key=lambda w: (-idf[w], w)):
        if left < most:
            break
        out.append(w)
        left -= idf[w] * phrase.count(w)
    return out


def _proposals(phrase: list[str], anchor: Column) -> Column:
    """Where the phrase may begin: as (start, index), by the places of its anchor."""

    def of_hit(h: Column, x: Column) -> Column:
        offsets = F.filter(F.sequence(F.lit(0), F.lit(len(phrase) - 1)), lambda o: F.get(_array(phrase), o) == h["word"])
        begins = F.transform(offsets, lambda o: F.struct((h["at"] - o).alias("start"), (x - o).alias("index")))
        return F.when(h["word"] == anchor, begins)

    found = F.flatten(F.filter(F.transform("hits", of_hit), lambda b: b.isNotNull()))
    return F.coalesce(F.when(anchor.isNotNull(), found), F.array().cast("array<struct<start:int,index:int>>"))


def _whole(phrase: list[str], proposals: Column) -> Column:
    """Starts of the places where the phrase stands word for word."""

    def stands(p: Column) -> Column:
        def same(j: Column) -> Column:
            hit = F.get("hits", p["index"] + j)
            return F.coalesce((hit["word"] == F.get(_array(phrase), j)) & (hit["at"] == p["start"] + j), F.lit(False))

        return F.forall(F.sequence(F.lit(0), F.lit(len(phrase) - 1)), same)

    return F.array_distinct(F.transform(F.filter(proposals, stands), lambda p: p["start"]))


def _postings(idf: dict[str, float]) -> Column:
    """All templates as one constant: words with their shares of the IDF weight, key phrase and heavy words."""
    rows = []
    for label, text, key in TEMPLATES:
        phrase = text.split()
        total = sum(idf[w] for w in phrase)
        rows.append(
            {
                "label": label, "words": phrase, "weights": [idf[w] / total for w in phrase], "key": key.split(),
                "heavy": _heavy(phrase, idf), "every": sorted(set(phrase)),
            }
        )
    kind = "array<struct<label:string,words:array<string>,weights:array<double>,key:array<string>,heavy:array<string>,every:array<string>>>"
    return F.from_json(F.lit(json.dumps(rows)), kind)


def _cover(t: Column) -> Column:
    """The greatest share of a template's IDF weight found at any place."""
    n = F.size(t["words"])

    def share(start: Column, index: Column) -> Column:
        def add(sum_: Column, h: Column) -> Column:
            at = h["at"] - start
            return sum_ + F.coalesce(F.when(F.get(t["words"], at) == h["word"], F.get(t["weights"], at)), F.lit(0.0))

        return F.aggregate(F.slice("hits", F.greatest(index, F.lit(0)) + 1, n), F.lit(0.0), add)

    def by(words_: Column) -> Column:
        def of_hit(h: Column, x: Column) -> Column:
            offsets = F.filter(F.sequence(F.lit(0), n - 1), lambda o: F.get(t["words"], o) == h["word"])
            return F.when(F.array_contains(words_, h["word"]), F.array_max(F.transform(offsets, lambda o: share(h["at"] - o, x - o))))

        return F.coalesce(F.array_max(F.transform("hits", of_hit)), F.lit(0.0))

    # Held as an array of one, so that it is worked out once.
    best = F.transform(F.array(by(t["heavy"])), lambda c: F.when(c >= COVER, c).otherwise(F.greatest(c, by(t["every"]))))
    return F.get(best, F.lit(0))


def _stands(t: Column) -> Column:
    """Whether the key phrase of a template stands word for word."""

    def begins(h: Column, x: Column) -> Column:
        def same(word: Column, j: Column) -> Column:
            hit = F.get("hits", x + j)
            return F.coalesce((hit["word"] == word) & (hit["at"] == h["at"] + j), F.lit(False))

        return F.when(h["word"] == F.get(t["key"], F.lit(0)), F.forall(F.transform(t["key"], same), lambda ok: ok)).otherwise(F.lit(False))

    return F.exists(F.transform("hits", begins), lambda ok: ok)


def licence_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels``,
    ``score`` (1 with a base phrase, else the greatest cover of any template whose key words the file has) and
    ``covers`` by template.

    NULL and empty texts have no words, no places (first and last NULL), no labels (empty strings) and score
    0. Repeated rows get equal results. Other columns are not read, so their names cannot clash.
    """
    index = written(indexed(docs, id_col, text_col), "licences")
    idf = inverse_frequencies(index)
    phrases = [phrase.split() for _, phrase in BASE]
    # Anchors are one column that is read often, so that Spark does not work them out for every place anew.
    held = index.withColumn("held", F.array_distinct(F.transform("hits", lambda h: h["word"])))
    anchored = held.withColumn("anchors", F.array(*[_anchor(p, p, idf) for p in phrases]))

    # A base phrase needs all its words, a template those of its key phrase.
    def compared(t: Column) -> Column:
        eligible = F.forall(t["key"], lambda w: F.array_contains("held", w))
        cover = F.when(eligible, _cover(t)).otherwise(F.lit(0.0))
        key = F.when(eligible, _stands(t)).otherwise(F.lit(False))
        return F.struct(t["label"].alias("label"), cover.alias("cover"), key.alias("key"))

    found = anchored.select(
        "doc_id",
        "n_words",
        F.array(*[_whole(p, _proposals(p, F.get("anchors", F.lit(n)))) for n, p in enumerate(phrases)]).alias("base"),
        F.transform(_postings(idf), compared).alias("method"),
    )
    starts = F.flatten("base")
    base_labels = [F.when(F.size(F.col("base")[n]) > 0, F.lit(label)) for n, (label, _) in enumerate(BASE)]
    more_labels = F.transform(F.filter("method", lambda m: (m["cover"] >= COVER) & m["key"]), lambda m: m["label"])

    def joined(labels: Column) -> Column:
        return F.concat_ws(",", F.array_sort(F.array_distinct(F.array_compact(labels))))

    best = F.array_max(F.transform("method", lambda m: m["cover"]))
    return found.select(
        "doc_id",
        "n_words",
        F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        joined(F.array(*base_labels)).alias("base_labels"),
        joined(F.concat(F.array(*base_labels), more_labels)).alias("labels"),
        F.when(F.size(starts) > 0, F.lit(1.0)).otherwise(F.least(best, F.lit(1.0))).alias("score"),
        F.transform("method", lambda m: m["cover"]).alias("covers"),
    )
