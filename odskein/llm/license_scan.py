"""License scan: which stretches of a document's words hold (most of) a license notice.

A notice is a template of a few words. It is looked for in windows of the document's whole word
sequence, line breaks and punctuation ignored: as many words as the template has, and one more for
each SLACK of them (for comment signs and words put in). A window matches where it holds at least
``threshold`` of the template's different words. Words are ordered by how many documents of the
whole corpus hold them, rarest first, and three filters come before any window is counted:

- prefix: a match must hold one of the template's rarest words, as many as may be missing and one;
- length: a document, and the reach around a prefix word, must hold as many words as the match needs;
- position: a window is counted at its rarest word, so only words that come after it in the order count.

Where a template has all words of another label's (cc-by-nc of cc-by), the more specific one wins: it
needs the words that set it apart, and a window with these words is no match of the other.

Each window around a place that passes is counted exactly. All of it is DataFrame expressions: one
scan for the words' frequencies, whose result is one row for each template word, and one scan for
the match, without a shuffle of texts.

Templates are a parameter of the job, so their vocabulary is bounded by the caller and stands in
the plan as literals. Defined results: null and empty texts have no words and no label; a text that
is shorter than a window is one window; repeated rows are scanned one by one; an empty table gives
no rows; other columns are not looked at.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odskein.llm.native import let, lower_az, plain_words, whole_text

# A window has one word more than its template for each so many words of it.
SLACK = 5
# Phrases whose words, one after the other, name a license: words and label.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
# Notices: label and text, in the wording that the licenses ask for.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache", "you may not use this file except in compliance with the license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
)
# The long forms of the restricted Creative Commons licenses, each of which holds all words of cc-by's.
LONG_FORMS = tuple(
    (f"cc-by-{label}", f"licensed under a creative commons attribution {words} 4 0 international license")
    for label, words in (
        ("nc", "noncommercial"),
        ("sa", "sharealike"),
        ("nd", "noderivatives"),
        ("nc-sa", "noncommercial sharealike"),
        ("nc-nd", "noncommercial noderivatives"),
    )
)
# Paragraphs that files carry whole; fixed values.
PARAGRAPHS = (
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation "
        "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to "
        "permit persons to whom the software is furnished to do so subject to the following conditions",
    ),
    (
        "bsd",
        "redistributions of source code must retain the above copyright notice this list of conditions and the "
        "following disclaimer redistributions in binary form must reproduce the above copyright notice this list of "
        "conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    ),
    (
        "apache",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
        "with the license you may obtain a copy of the license at",
    ),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation either version 3 of the license or at your "
        "option any later version",
    ),
)
NOTICES = TEMPLATES + LONG_FORMS + PARAGRAPHS


@dataclass(frozen=True)
class Notice:
    """A template in the global word order: rarest word first."""

    label: str
    words: tuple[str, ...]
    needed: int
    width: int
    own: tuple[str, ...] = ()  # words that set it apart from the templates it includes; all must be there
    others: tuple[tuple[str, ...], ...] = ()  # words that make it a more specific template's match

    @property
    def prefix(self) -> tuple[str, ...]:
        return self.words[: len(self.words) - self.needed + 1]


def word_frequencies(docs: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """How many documents hold each word of the templates (at most that many rows)."""
    held = F.array_distinct(F.filter(plain_words(lower_az(whole_text())), lambda w: w.isin(vocabulary)))
    rows = docs.select(F.explode(held).alias("word")).groupBy("word").count().collect()
    return {row["word"]: row["count"] for row in rows}


def ordered_notices(docs: DataFrame, templates=NOTICES, threshold: float = 0.8) -> list[Notice]:
    """Templates with their words in the global order and the overlap that a match needs."""
    said = [(label, text.split()) for label, text in templates]
    vocabulary = sorted(set().union(*[words for _, words in said]))
    counts = word_frequencies(docs, vocabulary)
    notices = []
    for label, words in said:
        ranked = sorted(set(words), key=lambda w: (counts.get(w, 0), w))
        needed = math.ceil(threshold * len(ranked) - 1e-9)
        rest = [set(w) for other, w in said if other != label]
        own = set().union(*[set(words) - w for w in rest if w < set(words)])
        others = tuple(tuple(sorted(w - set(words))) for w in rest if set(words) < w)
        notices.append(Notice(label, tuple(ranked), needed, len(words) + len(words) // SLACK, tuple(sorted(own)), others))
    return notices


def scan(docs: DataFrame, templates=NOTICES, phrases=PHRASES, threshold: float = 0.8) -> DataFrame:
    """One row for each document: words, places of the phrases, labels and the best containment."""
    notices = ordered_notices(docs, templates, threshold)
    text = F.col("text")
    read = docs.select(F.col("doc_id"), lower_az(whole_text()).alias("text")).select(
        "doc_id", "text", plain_words(text).alias("words")
    )
    prefix = sorted({word for notice in notices for word in notice.prefix})
    named = F.lit(False)
    for phrase, _ in phrases:
        for word in phrase.split()[-1:]:
            named = named | text.contains(word)
    suspect = F.size(F.filter("words", lambda w: w.isin(prefix))) > 0
    places = F.when(named, _places(F.col("words"), phrases))
    matches = F.when(suspect, _matches(F.col("words"), notices))
    return (
        read.select("doc_id", F.size("words").cast("long").alias("n_words"), places.alias("places"), matches.alias("matches"))
        .withColumn("places", F.coalesce("places", F.array().cast("array<struct<at:bigint,label:string>>")))
        .withColumn("matches", F.coalesce("matches", F.array().cast("array<struct<score:double,label:string>>")))
        .select(
            "doc_id",
            "n_words",
            F.size("places").cast("long").alias("n_base"),
            F.array_min("places")["at"].alias("first_word"),
            F.array_max("places")["at"].alias("last_word"),
            _joined(F.col("places.label")).alias("base_labels"),
            _joined(F.concat("places.label", "matches.label")).alias("labels"),
            F.when(F.size("places") > 0, F.lit(1.0))
            .otherwise(F.coalesce(F.array_max("matches")["score"], F.lit(0.0)))
            .alias("score"),
        )
    )


def _joined(labels: Column) -> Column:
    return F.concat_ws(",", F.array_sort(F.array_distinct(labels)))


def _places(words: Column, phrases) -> Column:
    """Where a phrase starts, and its label, for every place."""

    def label_at(w: Column, i: Column) -> Column:
        found = F.lit(None).cast("string")
        for phrase, label in phrases:
            first, *rest = phrase.split()
            test = w == first
            for k, word in enumerate(rest, 1):
                test = test & (F.get(words, i + k) == word)
            found = F.when(test, F.lit(label)).otherwise(found)
        return F.struct(i.cast("long").alias("at"), found.alias("label"))

    return F.filter(F.transform(words, label_at), lambda place: place["label"].isNotNull())


def _matches(words: Column, notices: list[Notice]) -> Column:
    """Label and containment of each template for each place where a window reaches the threshold."""
    vocabulary = sorted({word for notice in notices for word in notice.words})
    held = F.array_distinct(F.filter(words, lambda w: w.isin(vocabulary)))
    return let(held, lambda h: F.flatten(F.array(*[_found(words, h, notice) for notice in notices])))


def _found(words: Column, held: Column, notice: Notice) -> Column:
    """The matches of one template; none where the document lacks a prefix word or too many others."""
    listed = F.array(*map(F.lit, notice.words))
    prefix = F.array(*map(F.lit, notice.prefix))
    possible = F.arrays_overlap(held, prefix) & (F.size(F.array_intersect(held, listed)) >= notice.needed)
    places = F.filter(
        F.transform(words, lambda w, i: F.struct(i.alias("at"), F.array_position(prefix, w).cast("int").alias("rank"))),
        lambda place: place["rank"] > 0,
    )
    scores = F.filter(F.transform(places, lambda place: _best(words, place, listed, notice)), lambda m: m.isNotNull())
    return F.when(possible, scores).otherwise(F.array().cast("array<struct<score:double,label:string>>"))


def _best(words: Column, place: Column, listed: Column, notice: Notice) -> Column:
    """The best window whose rarest word stands at the place, or null where none reaches the threshold."""
    at, width = place["at"], notice.width
    first = F.greatest(at - (width - 1), F.lit(0))
    # words before the place's in the order are another place's to count
    later = F.slice(listed, place["rank"], F.lit(len(notice.words)))

    def shared(begin: Column, size: Column, counted: Column) -> Column:
        return F.size(F.array_intersect(F.slice(words, begin + 1, size), counted))

    def holds(begin: Column, some: tuple[str, ...]) -> Column:
        return shared(begin, F.lit(width), F.array(*map(F.lit, some))) == len(some)

    def window(begin: Column, counted: Column) -> Column:
        found = shared(begin, F.lit(width), counted)
        for some in notice.others:
            found = F.when(~holds(begin, some), found)
        return F.when(holds(begin, notice.own), found) if notice.own else found

    def of(counted: Column) -> Column:
        windows = F.transform(F.sequence(first, at), lambda begin: window(begin, counted))
        best = F.when(shared(first, at - first + width, counted) >= notice.needed, F.array_max(windows))
        pair = lambda n: F.struct((n / F.lit(len(notice.words))).alias("score"), F.lit(notice.label).alias("label"))
        return let(best, lambda n: F.when(n >= notice.needed, pair(n)))

    return let(later, of)
