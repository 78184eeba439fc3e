"""Licence scan by sentences: known sentences become identifiers, and ordered rules read the identifier sequence."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmill.llm.common import lower_ascii, once, table

#: Known sentences in normal form (lower case, only a-z and 0-9, single spaces) and their identifiers. Fixed values.
SENTENCES = {
    "licensed under cc by nc 4 0": "ByNc4Ref",
    "licensed under cc by 4 0": "By4Ref",
    "licensed under cc by sa 4 0": "BySa4Ref",
    "this work is licensed under a creative commons attribution 4 0 international license": "By4Ref",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "ByNc4Ref",
    "this work is licensed under the gnu general public license version 3": "Gpl3Ref",
    "licensed under the gnu general public license version 3": "Gpl3Ref",
    "licensed under the gnu general public license version 2": "Gpl2Ref",
    "this program is free software": "GplFree",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "GplTerms",
    "either version 3 of the license or at your option any later version": "Gpl3Plus",
    "either version 2 of the license or at your option any later version": "Gpl2Plus",
    "licensed under the apache license version 2 0": "Apache2Ref",
    "licensed under the apache license version 2 0 the license": "Apache2Pre",
    "you may not use this file except in compliance with the license": "Apache2Comply",
    "you may obtain a copy of the license at http www apache org licenses license 2 0": "Apache2Copy",
    "released under the mit license": "MitRef",
    "licensed under the mit license": "MitRef",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "MitGrant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "MitNotice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "MitAsIs",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "BsdPre",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "BsdSource",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "BsdBinary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BsdNames",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "IscGrant",
    "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness": "IscAsIs",
    "this source code form is subject to the terms of the mozilla public license v": "Mpl2Terms",
    "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0": "Mpl2Copy",
    "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0": "Mpl2Copy",
    "this library is free software": "LgplFree",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation": "LgplTerms",
    "either version 2 1 of the license or at your option any later version": "Lgpl21Plus",
    "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation": "AgplTerms",
    "this is free and unencumbered software released into the public domain": "Unlicense",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions": "ZlibGrant",
    "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0": "Epl2Ref",
    "all rights reserved": "Reserved",
}

#: Names by which a file says its licence, and the identifier of that; with a clause before and one after them they make
#: the sentences below. Fixed values.
NAMED = {
    "the mit license": "MitRef",
    "the isc license": "IscRef",
    "the zlib license": "ZlibRef",
    "the bsd 2 clause license": "Bsd2Ref",
    "the bsd 3 clause license": "Bsd3Ref",
    "the apache license 2 0": "Apache2Ref",
    "the apache license version 2 0": "Apache2Ref",
    "the mozilla public license 2 0": "Mpl2Ref",
    "the mozilla public license version 2 0": "Mpl2Ref",
    "the eclipse public license 2 0": "Epl2Ref",
    "the unlicense": "Unlicense",
}
#: Fixed values.
BEFORE = ["licensed under", "released under", "distributed under", "this project is licensed under", "this software is licensed under"]
AFTER = ["", "see license", "see license for details", "see the license file for details"]
for _name, _id in NAMED.items():
    for _before in BEFORE:
        for _after in AFTER:
            SENTENCES.setdefault(f"{_before} {_name} {_after}".strip(), _id)

#: Identifiers of the public licence list that a tag names, as in "SPDX-License-Identifier: MIT". Fixed values.
TAGGED = [
    "MIT", "ISC", "Zlib", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "MPL-2.0", "EPL-2.0", "Unlicense", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0",
    "CC-BY-NC-4.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only",
    "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later",
]
#: Addresses of licence texts, without the scheme. Fixed values.
ADDRESSES = {
    "opensource.org/licenses/MIT": "MIT",
    "opensource.org/licenses/ISC": "ISC",
    "opensource.org/licenses/BSD-2-Clause": "BSD-2-Clause",
    "opensource.org/licenses/BSD-3-Clause": "BSD-3-Clause",
    "www.apache.org/licenses/LICENSE-2.0": "Apache-2.0",
    "www.mozilla.org/MPL/2.0/": "MPL-2.0",
    "www.eclipse.org/legal/epl-2.0/": "EPL-2.0",
    "creativecommons.org/licenses/by/4.0/": "CC-BY-4.0",
    "creativecommons.org/licenses/by-sa/4.0/": "CC-BY-SA-4.0",
    "creativecommons.org/licenses/by-nc/4.0/": "CC-BY-NC-4.0",
    "creativecommons.org/publicdomain/zero/1.0/": "CC0-1.0",
    "www.gnu.org/licenses/gpl-3.0.html": "GPL-3.0-only",
    "www.gnu.org/licenses/old-licenses/gpl-2.0.html": "GPL-2.0-only",
}


def normal(sentence: str) -> str:
    return " ".join(re.sub("[^a-z0-9]+", " ", sentence.lower()).split())


for _tag in TAGGED:
    SENTENCES[normal(f"SPDX-License-Identifier {_tag}")] = f"Tag:{_tag}"
for _address, _name in ADDRESSES.items():
    for _scheme in ("http", "https"):
        SENTENCES[normal(f"{_scheme} {_address}")] = f"Tag:{_name}"

#: Known sentences of several others in one, as where a comma stands for a semicolon, and their identifiers.
COMPOUND = {
    f"{terms} {later}": (kind, name)
    for terms, kind in SENTENCES.items()
    if kind in ("GplTerms", "LgplTerms", "AgplTerms")
    for later, name in SENTENCES.items()
    if name in ("Gpl3Plus", "Gpl2Plus", "Lgpl21Plus")
}

#: (licence, identifiers that follow each other). Earlier rules take their sentences first, so longer ones stand
#: before the shorter ones they contain. Fixed values.
_RUNS = [
    ("BSD-3-Clause", ["BsdPre", "BsdSource", "BsdBinary", "BsdNames"]),
    ("BSD-2-Clause", ["BsdPre", "BsdSource", "BsdBinary"]),
    ("MIT", ["MitGrant", "MitNotice", "MitAsIs"]),
    ("MIT", ["MitGrant", "MitNotice"]),
    ("ISC", ["IscGrant", "IscAsIs"]),
    ("ISC", ["IscGrant"]),
    ("Zlib", ["ZlibGrant"]),
    ("Apache-2.0", ["Apache2Pre", "Apache2Comply", "Apache2Copy"]),
    ("Apache-2.0", ["Apache2Pre", "Apache2Comply"]),
    ("MPL-2.0", ["Mpl2Terms", "Mpl2Copy"]),
    ("GPL-3.0-or-later", ["GplFree", "GplTerms", "Gpl3Plus"]),
    ("GPL-2.0-or-later", ["GplFree", "GplTerms", "Gpl2Plus"]),
    ("GPL", ["GplFree", "GplTerms"]),
    ("LGPL-3.0-or-later", ["LgplFree", "LgplTerms", "Gpl3Plus"]),
    ("LGPL-2.1-or-later", ["LgplFree", "LgplTerms", "Lgpl21Plus"]),
    ("LGPL-3.0-or-later", ["GplFree", "LgplTerms", "Gpl3Plus"]),
    ("AGPL-3.0-or-later", ["GplFree", "AgplTerms", "Gpl3Plus"]),
]
#: A copyright line may end with the reservation that another one is read from; it is part of the licence that follows.
_LONG = [(name, ["Reserved", *run]) for name, run in _RUNS]
RULES = [rule for both in zip(_LONG, _RUNS) for rule in both] + [
    ("CC-BY-NC-4.0", ["ByNc4Ref"]),
    ("CC-BY-SA-4.0", ["BySa4Ref"]),
    ("CC-BY-4.0", ["By4Ref"]),
    ("GPL-3.0-only", ["Gpl3Ref"]),
    ("GPL-2.0-only", ["Gpl2Ref"]),
    ("Apache-2.0", ["Apache2Ref"]),
    ("Apache-2.0", ["Apache2Pre"]),
    ("MIT", ["MitRef"]),
    ("ISC", ["IscRef"]),
    ("Zlib", ["ZlibRef"]),
    ("BSD-2-Clause", ["Bsd2Ref"]),
    ("BSD-3-Clause", ["Bsd3Ref"]),
    ("MPL-2.0", ["Mpl2Ref"]),
    ("EPL-2.0", ["Epl2Ref"]),
    ("Unlicense", ["Unlicense"]),
    *((name, [f"Tag:{name}"]) for name in TAGGED),
]
#: Rules that speak only where no other one does.
FALLBACK = [("Proprietary", ["Reserved"])]

#: A sentence ends at . ! ? ; or : before white space, or at the end of the text.
SENTENCE_END = r"[.!?;:]+(?:[\x20\x09-\x0D]+|$)"
#: The colon of this tag doesn't end one.
TAG = r"(?i)spdx-license-identifier:"


def anchors(sentences: Iterable[str]) -> list[str]:
    """Few words of which every known sentence holds one, chosen greedily: the word most sentences share goes first."""
    left, chosen = [set(s.split()) for s in sentences], []
    while left:
        counts: dict[str, int] = {}
        for words in left:
            for word in words:
                if len(word) > 4:
                    counts[word] = counts.get(word, 0) + 1
        if not counts:
            return []
        best = min(counts, key=lambda w: (-counts[w], w))
        chosen.append(best)
        left = [words for words in left if best not in words]
    return chosen


def known_pattern(sentences: Iterable[str]) -> str:
    """Any of the sentences, in the text's form in ``_known``; longer ones are tried first."""
    return "|".join("[ L]+".join(s.split()) for s in sorted(sentences, key=lambda s: (-len(s), s)))


def _known(text: Column, sentences: dict[str, tuple[str, ...]]) -> Column:
    """Identifiers of the known sentences of ``text``, in order.

    In lower case, E stands for the end of a sentence and L for a line break, so one search finds a known sentence
    between any two of them, whatever line breaks stand inside.
    """
    lower = lower_ascii(F.regexp_replace(text, TAG, "spdx-license-identifier "))
    marked = F.translate(F.regexp_replace(lower, SENTENCE_END, "E"), "\n", "L")
    plain = F.regexp_replace(marked, "[^a-z0-9EL]+", " ")
    pattern = f"(?:^|[EL]) ?({known_pattern(sentences)})(?= ?(?:[EL]|$))"
    names = F.create_map(*(x for s in sentences for x in (F.lit(s), F.array(*map(F.lit, sentences[s])))))
    found = F.regexp_extract_all(plain, F.lit(pattern), 1)
    return F.flatten(F.transform(found, lambda s: F.try_element_at(names, F.regexp_replace(s, "[ L]+", " "))))


def all_known() -> dict[str, tuple[str, ...]]:
    return {s: (i,) for s, i in SENTENCES.items()} | COMPOUND


def sentence_ids(text: Column, sentences: dict[str, str] | None = None) -> Column:
    """The identifiers of a text's known sentences in order; empty for null.

    A line break, blank lines too, may end a sentence or stand inside one; both hold at every place of the text, so a
    wrapped sentence is known after a heading without a full stop. Where known sentences overlap, the one that begins
    first holds, and the longest of these. Leading comment signs don't matter, as a sentence is compared by its
    letters and digits.
    """
    known = all_known() if sentences is None else {s: (i,) for s, i in sentences.items()}
    words = anchors(known)
    test = "(?i)" + "|".join(words) if words else None
    nothing = F.array().cast("array<string>")
    if not known:
        return nothing
    # A text without any anchor word has no known sentence: one search spares it the rest.
    return F.when(text.rlike(test) if test else text.isNotNull(), _known(text, known)).otherwise(nothing)


def match_rules(ids: Column, rules: list[tuple[str, list[str]]], fallback: Sequence[tuple[str, list[str]]] = ()) -> Column:
    """``struct(licenses, rest)``: licences of the rules in order of the rules, each once, and identifiers no rule took.

    A rule takes every run of identifiers equal to its own, wherever it stands; what it took is gone for later ones.
    Where no rule of ``rules`` took anything, those of ``fallback`` may.
    """
    first = _matched(ids, rules)
    return once(first, lambda m: F.when(F.size(m["licenses"]) > 0, m).otherwise(_matched(ids, list(fallback)))) if fallback else first


def _matched(ids: Column, rules: list[tuple[str, list[str]]]) -> Column:
    table_ = F.array(*(F.struct(F.lit(n).alias("name"), F.lit("".join(f"<{i}>" for i in seq)).alias("run")) for n, seq in rules))
    start = F.struct(
        F.concat_ws("", F.transform(ids, lambda i: F.concat(F.lit("<"), i, F.lit(">")))).alias("seq"),
        F.array().cast("array<string>").alias("found"),
    )
    return F.aggregate(
        table_,
        start,
        lambda acc, r: F.when(
            F.contains(acc["seq"], r["run"]),
            F.struct(
                F.replace(acc["seq"], r["run"], F.lit("~")).alias("seq"),
                F.array_union(acc["found"], F.array(r["name"])).alias("found"),
            ),
        ).otherwise(acc),
        lambda acc: F.struct(acc["found"].alias("licenses"), F.regexp_extract_all(acc["seq"], F.lit("<([^>]*)>"), 1).alias("rest")),
    )


def scan_licenses(
    docs: DataFrame,
    text: str = "text",
    sentences: dict[str, str] | None = None,
    rules: list[tuple[str, list[str]]] | None = None,
) -> DataFrame:
    """``docs`` with ``license_sentences`` (identifiers in order), ``licenses`` and ``unruled`` (identifiers no rule took).

    Narrow: one projection, no shuffle, whole texts. Null and empty texts have three empty arrays; rows are neither
    dropped nor merged, so repeated rows stay; columns of ``docs`` named like the new ones are replaced.
    """
    rules, fallback = (RULES, FALLBACK) if rules is None else (rules, [])
    own = ("license_sentences", "licenses", "unruled", "_scan")
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in own]
    scan = once(
        sentence_ids(F.col(f"`{text}`"), sentences),
        lambda ids: F.struct(
            ids.alias("ids"),
            F.when(F.size(ids) > 0, match_rules(ids, rules, fallback)).otherwise(
                F.struct(F.array().cast("array<string>").alias("licenses"), F.array().cast("array<string>").alias("rest"))
            ).alias("m"),
        ),
    )
    return docs.select(*kept, scan.alias("_scan")).select(
        *kept,
        F.col("_scan.ids").alias("license_sentences"),
        F.col("_scan.m.licenses").alias("licenses"),
        F.col("_scan.m.rest").alias("unruled"),
    )


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.size("license_sentences").cast("long").alias("n_sentences"),
        F.concat_ws(",", "license_sentences").alias("sentence_ids"),
        F.concat_ws(",", "licenses").alias("licenses"),
        F.concat_ws(",", "unruled").alias("unruled"),
    )


def oracle() -> str:
    """The same in plain SQL, one step per rule. Ends of sentences and lines are written twice there, since its patterns
    can't look ahead, and each match then takes its own."""
    known = ", ".join(f"('{s}', {list(ids)})" for s, ids in all_known().items())

    def steps(rules: list[tuple[str, list[str]]], start: str, label: str) -> tuple[list[str], str]:
        made, last = [], start
        for n, (name, seq) in enumerate(rules):
            run = "".join(f"<{i}>" for i in seq)
            made.append(
                f"{label}{n} as materialized (select doc_id, ids, replace(seq, '{run}', '~') seq, case when contains(seq, '{run}') and not"
                f" list_contains(found, '{name}') then list_append(found, '{name}') else found end found from {last})"
            )
            last = f"{label}{n}"
        return made, last

    rules, ruled = steps(RULES, "begun", "r")
    others, last = steps(FALLBACK, "unruled", "f")
    return f"""
with known(sentence, ids) as (values {known}),
plain as (select doc_id, regexp_replace(replace(regexp_replace(translate(regexp_replace(text, '{TAG}', 'spdx-license-identifier ', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{SENTENCE_END}', 'EE', 'g'), chr(10), 'LL'), '[^a-z0-9EL]+', ' ', 'g') p from documents
    where regexp_matches(text, '(?i){"|".join(anchors(all_known()))}')),
matches as (select doc_id, regexp_extract_all(p, '(?:^|[EL]) ?({known_pattern(all_known())}) ?(?:[EL]|$)', 1) m from plain),
each as (select doc_id, unnest(m) s, unnest(range(len(m))) pos from matches),
named as (select doc_id, flatten(list(ids order by pos)) ids from each join known on sentence = regexp_replace(s, '[ L]+', ' ', 'g') group by doc_id),
begun as (select doc_id, ids, array_to_string(list_transform(ids, lambda i: '<' || i || '>'), '') seq, []::varchar[] found from named),
{", ".join(rules)},
unruled as (select r.doc_id, r.ids, s.seq, r.found from {ruled} r join begun s using (doc_id) where len(r.found) = 0),
{", ".join(others)},
done as (select * from {ruled} where len(found) > 0 union all select * from {last})
select d.doc_id, coalesce(len(ids), 0)::bigint n_sentences, coalesce(array_to_string(ids, ','), '') sentence_ids,
  coalesce(array_to_string(found, ','), '') licenses, coalesce(array_to_string(regexp_extract_all(seq, '<([^>]*)>', 1), ','), '') unruled
from documents d left join done using (doc_id)
"""


ORACLE = oracle()
