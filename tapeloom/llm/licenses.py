"""Operator 11, license scans: ordered signature rules over a text's words, gated by keywords. Native.

A text becomes its words: lower case, parted by two spaces, one at either end, so that a rule's regular
expression, which names whole words, takes the spaces around them and matches that follow each other do not
compete for one. The keywords of all rules are looked up among a text's words in one pass; a rule is run only
where a keyword of each of its two groups is there. Detections are resolved by priority: one that lies
within another of the same or a better priority goes (of equal spans, the better priority, then the earlier
rule stays). Base rules' places are counted and their labels stay, whatever suppresses them.

Rules are some hundreds: signatures, written by hand, of sentences that only license texts have and of each
license's name, and around each name the ways in which notices name a license.

Defined results: null text is empty; null and repeated ids are kept, each row is scanned; an empty table
gives an empty result; columns other than the id and the text are not looked at. Work is linear in the text
for each rule that is run, and in the detections. Lower case is that of Unicode: the Kelvin sign is a k.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.functions import arrays

#: What parts words, in lower case.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PRIORITIES = 3


@dataclass(frozen=True)
class Rule:
    """``pattern`` over words, a space between two. Each match has a word of ``first`` and one of ``second``. ``priority``: 0 is the best; ``score``: how sure a match is."""

    label: str
    pattern: str
    first: tuple[str, ...]
    second: tuple[str, ...]
    priority: int
    score: float
    base: bool = False

    @property
    def regex(self) -> str:
        return " " + self.pattern.replace(" ", "  ") + " "


#: The phrases that are always counted.
BASE = (
    Rule("mit", "under the mit license", ("mit",), ("license",), 1, 0.9, True),
    Rule("apache-2", "apache license version 2", ("apache",), ("license",), 1, 0.9, True),
    Rule("cc-by-nc", "cc by nc", ("cc",), ("nc",), 1, 0.8, True),
)

#: Sentences of license texts and notices of their own wording: label, two words that a match has, pattern.
SENTENCES = (
    ("mit", "hereby", "documentation", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "notice", "substantial", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("apache-2", "compliance", "license", "you may not use this file except in compliance with the license"),
    ("apache-2", "apache", "licenses", "www apache org licenses license 2 0"),
    ("bsd-2-clause", "redistributions", "reproduce", "redistributions in binary form must reproduce the above copyright notice this list of conditions"),
    ("bsd-3-clause", "contributors", "endorse", "neither the name of (?:[^ ]+ ){1,12}nor the names of its contributors may be used to endorse"),
    ("bsd-4-clause", "advertising", "acknowledgement", "all advertising materials mentioning features or use of this software must display the following acknowledgement"),
    ("isc", "permission", "hereby", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("zlib", "altered", "misrepresented", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("gpl-2", "license", "later", "either version 2 of the license or at your option any later version"),
    ("gpl-3", "license", "later", "either version 3 of the license or at your option any later version"),
    ("gpl", "redistribute", "gnu", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "redistribute", "gnu", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("gpl-2", "gnu", "licenses", "www gnu org licenses old licenses gpl 2 0"),
    ("gpl-3", "gnu", "licenses", "www gnu org licenses gpl 3 0"),
    ("agpl-3", "remote", "gnu", "remote network interaction use with the gnu general public license"),
    ("mpl-2", "mozilla", "license", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-2", "mozilla", "mpl", "mozilla org mpl 2 0"),
    ("mpl-1.1", "mozilla", "license", "the contents of this file are subject to the mozilla public license version 1 1"),
    ("epl-2", "eclipse", "license", "the accompanying materials are provided under the terms of this eclipse public license"),
    ("cddl-1", "distribution", "license", "the contents of this file are subject to the terms of the common development and distribution license"),
    ("bsl-1", "hereby", "accompanying", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("ms-pl", "accept", "license", "if you use the software you accept this license if you do not accept the license do not use the software"),
    ("psf-2", "psf", "licensee", "psf is making python available to licensee on an as is basis"),
    ("openssl", "openssl", "toolkit", "this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("ofl-1.1", "sil", "license", "this font software is licensed under the sil open font license"),
    ("unlicense", "unencumbered", "domain", "this is free and unencumbered software released into the public domain"),
    ("wtfpl", "fuck", "want", "you just do what the fuck you want to"),
    ("cc0", "waived", "neighboring", "to the extent possible under law (?:[^ ]+ ){1,12}waived all copyright and related or neighboring rights"),
    ("cc0", "creativecommons", "publicdomain", "creativecommons org publicdomain zero 1 0"),
    ("cc-by", "creativecommons", "licenses", "creativecommons org licenses by [1-4] [05]"),
    ("cc-by-sa", "creativecommons", "licenses", "creativecommons org licenses by sa [1-4] [05]"),
    ("cc-by-nd", "creativecommons", "licenses", "creativecommons org licenses by nd [1-4] [05]"),
    ("cc-by-nc", "creativecommons", "licenses", "creativecommons org licenses by nc [1-4] [05]"),
    ("cc-by-nc-sa", "creativecommons", "licenses", "creativecommons org licenses by nc sa [1-4] [05]"),
    ("cc-by-nc-nd", "creativecommons", "licenses", "creativecommons org licenses by nc nd [1-4] [05]"),
    ("proprietary", "reserved", "unauthorized", "all rights reserved unauthorized (?:copying|reproduction|use)(?: or distribution)?"),
    ("proprietary", "proprietary", "confidential", "proprietary and confidential"),
    ("public-domain", "public", "domain", "this (?:work|file|software|document) (?:is|was|has been) (?:placed |released )?(?:in|into) the public domain"),
)


def _version(major: str, minor: str = "0") -> str:
    """A version number after a name: "2", "v2", "v 2 0", "version 2 0". Minor numbers other than 0 must be there."""
    end = "(?: 0)?" if minor == "0" else f" {minor}"
    return f"(?: version {major}| v {major}| v{major}| {major}){end}"


_CC = "(?: [1-4] [05])?(?: international| unported| generic)?"
#: Licenses as notices name them: label, the name as an SPDX tag, the name in prose, words one of which the tag and the name have.
NAMES = (
    ("mit", "mit", "(?:mit|expat)", "mit expat"),
    ("mit-0", "mit 0", "mit no attribution", "mit"),
    ("apache-1.1", "apache 1 1", "apache(?: software)? license" + _version("1", "1"), "apache"),
    ("apache-2", "apache 2 0", "apache(?: software)?(?: license)?" + _version("2"), "apache"),
    ("bsd-2-clause", "bsd 2 clause", "(?:simplified bsd|freebsd|bsd 2 clause|2 clause bsd|two clause bsd)", "bsd freebsd"),
    ("bsd-3-clause", "bsd 3 clause", "(?:new bsd|revised bsd|modified bsd|bsd 3 clause|3 clause bsd|three clause bsd)", "bsd"),
    ("bsd-4-clause", "bsd 4 clause", "(?:original bsd|bsd 4 clause|4 clause bsd|four clause bsd)", "bsd"),
    ("0bsd", "0bsd", "(?:0bsd|zero clause bsd|bsd zero clause|0 clause bsd)", "0bsd bsd"),
    ("isc", "isc", "(?:isc|internet systems consortium)", "isc consortium"),
    ("zlib", "zlib", "zlib(?: libpng)?", "zlib"),
    ("gpl-1", "gpl 1 0(?: only| or later)?", "(?:gnu )?(?:gpl|general public license)" + _version("1"), "gpl general"),
    ("gpl-2", "gpl 2 0(?: only| or later)?", "(?:gnu )?(?:gplv2|(?:gpl|general public license)" + _version("2") + ")", "gpl gplv2 general"),
    ("gpl-3", "gpl 3 0(?: only| or later)?", "(?:gnu )?(?:gplv3|(?:gpl|general public license)" + _version("3") + ")", "gpl gplv3 general"),
    ("lgpl-2", "lgpl 2 0(?: only| or later)?", "(?:gnu )?(?:lgpl|library general public license)" + _version("2"), "lgpl library"),
    ("lgpl-2.1", "lgpl 2 1(?: only| or later)?", "(?:gnu )?(?:lgpl|lesser general public license)" + _version("2", "1"), "lgpl lesser"),
    ("lgpl-3", "lgpl 3 0(?: only| or later)?", "(?:gnu )?(?:lgplv3|(?:lgpl|lesser general public license)" + _version("3") + ")", "lgpl lgplv3 lesser"),
    ("agpl-3", "agpl 3 0(?: only| or later)?", "(?:gnu )?(?:agplv3|(?:agpl|affero general public license)" + _version("3") + ")", "agpl agplv3 affero"),
    ("mpl-1.1", "mpl 1 1", "(?:mpl|mozilla public license)" + _version("1", "1"), "mpl mozilla"),
    ("mpl-2", "mpl 2 0", "(?:mpl|mozilla public license)" + _version("2"), "mpl mozilla"),
    ("epl-1", "epl 1 0", "(?:epl|eclipse public license)" + _version("1"), "epl eclipse"),
    ("epl-2", "epl 2 0", "(?:epl|eclipse public license)" + _version("2"), "epl eclipse"),
    ("cddl-1", "cddl 1 0", "(?:cddl|common development and distribution license)" + _version("1"), "cddl development"),
    ("cpl-1", "cpl 1 0", "common public license" + _version("1"), "cpl common"),
    ("eupl-1.2", "eupl 1 2", "(?:eupl|european union public (?:license|licence))" + _version("1", "2"), "eupl european"),
    ("artistic-1", "artistic 1 0", "artistic license" + _version("1"), "artistic"),
    ("artistic-2", "artistic 2 0", "artistic license" + _version("2"), "artistic"),
    ("bsl-1", "bsl 1 0", "boost software license" + _version("1"), "bsl boost"),
    ("busl-1.1", "busl 1 1", "business source license" + _version("1", "1"), "busl business"),
    ("ms-pl", "ms pl", "microsoft public license", "pl microsoft"),
    ("ms-rl", "ms rl", "microsoft reciprocal license", "rl microsoft"),
    ("psf-2", "psf 2 0", "python software foundation license(?:" + _version("2") + ")?", "psf python"),
    ("postgresql", "postgresql", "postgresql", "postgresql"),
    ("openssl", "openssl", "openssl", "openssl"),
    ("ofl-1.1", "ofl 1 1", "(?:sil )?open font license" + _version("1", "1"), "ofl font"),
    ("unlicense", "unlicense", "unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "(?:wtfpl|do what the fuck you want to public license)", "wtfpl fuck"),
    ("ncsa", "ncsa", "(?:ncsa|university of illinois ncsa open source)", "ncsa"),
    ("upl-1", "upl 1 0", "universal permissive license(?:" + _version("1") + ")?", "upl permissive"),
    ("osl-3", "osl 3 0", "open software license" + _version("3"), "osl open"),
    ("afl-3", "afl 3 0", "academic free license" + _version("3"), "afl academic"),
    ("cecill-2.1", "cecill 2 1", "cecill(?: free software license agreement)?" + _version("2", "1"), "cecill"),
    ("mulan-2", "mulanpsl 2 0", "mulan permissive software license" + _version("2"), "mulanpsl mulan"),
    ("sspl-1", "sspl 1 0", "(?:sspl|server side public license)" + _version("1"), "sspl server"),
    ("elastic-2", "elastic 2 0", "elastic license" + _version("2"), "elastic"),
    ("odbl-1", "odbl 1 0", "(?:odbl|open database license)(?:" + _version("1") + ")?", "odbl database"),
    ("pddl-1", "pddl 1 0", "public domain dedication and license(?:" + _version("1") + ")?", "pddl dedication"),
    ("gfdl-1.3", "gfdl 1 3(?: only| or later)?", "(?:gnu )?free documentation license" + _version("1", "3"), "gfdl documentation"),
    ("cc0", "cc0 1 0", "(?:cc0|creative commons zero)(?: 1 0)?(?: universal)?", "cc0 creative"),
    ("cc-by", "cc by [1-4] [05]", "(?:cc by|creative commons attribution) [1-4] [05](?: international| unported| generic)?", "cc creative"),
    ("cc-by-sa", "cc by sa [1-4] [05]", "(?:cc by sa|creative commons attribution (?:sharealike|share alike))" + _CC, "cc creative"),
    ("cc-by-nd", "cc by nd [1-4] [05]", "(?:cc by nd|creative commons attribution (?:noderivatives|noderivs|no derivatives))" + _CC, "cc creative"),
    ("cc-by-nc", "cc by nc [1-4] [05]", "(?:cc by nc|creative commons attribution (?:noncommercial|non commercial))" + _CC, "cc creative"),
    ("cc-by-nc-sa", "cc by nc sa [1-4] [05]", "(?:cc by nc sa|creative commons attribution (?:noncommercial|non commercial) (?:sharealike|share alike))" + _CC, "cc creative"),
    ("cc-by-nc-nd", "cc by nc nd [1-4] [05]", "(?:cc by nc nd|creative commons attribution (?:noncommercial|non commercial) (?:noderivatives|noderivs|no derivatives))" + _CC, "cc creative"),
)

_THE = "(?: the terms of)?(?: the| a| an)?"
#: How notices name a license: the words around its name, words one of which they have, priority and score.
AROUND = (
    ("(?:licensed|licenced|released|distributed|available|published|provided) under" + _THE + " {}(?: license| licence)?", "licensed licenced released distributed available published provided", 1, 0.95),
    ("(?:under|subject to) the terms (?:of|and conditions of)(?: the| a| an)? {}(?: license| licence)?", "terms", 1, 0.9),
    ("(?:license|licence)(?: is| type)?(?: the)? {}", "license licence", 2, 0.8),
    ("{} (?:license|licence)", "license licence", 2, 0.7),
)


def _rules() -> tuple[Rule, ...]:
    out = list(BASE)
    out += [Rule(label, sentence, (a,), (b,), 0, 1.0) for label, a, b, sentence in SENTENCES]
    out += [Rule(label, f"spdx license identifier {tag}", tuple(has.split()), ("spdx",), 0, 1.0) for label, tag, _, has in NAMES]
    out += [Rule(label, around.format(name), tuple(has.split()), tuple(words.split()), priority, score) for around, words, priority, score in AROUND for label, _, name, has in NAMES]
    return tuple(out)


#: In order: where priorities and spans are equal, the earlier one stays.
RULES = _rules()

_RULE = "struct<rank:int,label:string,regex:string,first:array<string>,second:array<string>,priority:int,score:double,base:boolean>"
DETECTION = "struct<start:int,back:int,priority:int,rank:int,label:string,score:double,base:boolean>"


def keywords(rules=RULES) -> list[str]:
    return sorted({w for r in rules for w in r.first + r.second})


def _n_words(c: Column) -> Column:
    """Words of a stretch of the normal form, which has two spaces for each."""
    return F.floor((F.octet_length(c) - F.octet_length(F.replace(c, F.lit(" "), F.lit("")))) / 2).cast("int")


def _places(normal: Column, r: Column) -> Column:
    """Where a rule matches: spans in words, ``back`` the end exclusive, negated, to sort by."""
    pieces = F.struct(F.regexp_extract_all(normal, r["regex"], F.lit(0)).alias("hits"), F.split(normal, r["regex"], -1).alias("gaps"))

    def placed(v: Column) -> Column:
        sizes = F.transform(v["hits"], lambda h, i: _n_words(F.get(v["gaps"], i)) + _n_words(h))
        ends = arrays.running(sizes, lambda x, y: x + y)
        one = lambda e, h: F.struct((e - _n_words(h)).alias("start"), (-e).alias("back"), *[r[c].alias(c) for c in ("priority", "rank", "label", "score", "base")])
        return F.zip_with(ends, v["hits"], one)

    return arrays.bind(pieces, placed)


def _standing(ordered: Column) -> Column:
    """Detections in the order of ``detections`` without those that lie within another of the same or a better priority.

    One that holds another comes before it, so that the largest end so far, among those of no worse priority, tells.
    """
    ends = F.array(*[arrays.running(F.transform(ordered, lambda d: F.when(d["priority"] <= p, -d["back"]).otherwise(0)), F.greatest) for p in range(PRIORITIES)])
    return arrays.bind(ends, lambda e: F.filter(ordered, lambda d, i: F.coalesce(F.get(F.get(e, d["priority"]), i - 1), F.lit(0)) < -d["back"]))


def find_licenses(docs: DataFrame, rules=RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, n_words, detections, standing): ``detections`` by start, then longest first, then priority and rule; ``standing`` those that are not suppressed."""
    fixed = [asdict(r) | {"rank": i, "regex": r.regex} for i, r in enumerate(rules)]
    table = F.from_json(F.lit(json.dumps(fixed)), f"array<{_RULE}>")
    words = F.trim(F.regexp_replace(F.lower(F.coalesce(F.col(text), F.lit(""))), GAP, " "))
    one = docs.select(F.col(key).alias(key), words.alias("words"))
    have = F.array_intersect(F.split("words", " "), F.array(*map(F.lit, keywords(rules))))
    one = one.select(
        key,
        F.when(F.col("words") == "", 0).otherwise(F.length("words") - F.length(F.replace("words", F.lit(" "), F.lit(""))) + 1).cast("long").alias("n_words"),
        "words",
        have.alias("have"),
    )

    def run(normal: Column) -> Column:
        may = F.filter(table, lambda r: F.arrays_overlap("have", r["first"]) & F.arrays_overlap("have", r["second"]))
        return F.sort_array(F.flatten(F.transform(may, lambda r: _places(normal, r)))).cast(f"array<{DETECTION}>")

    normal = F.concat(F.lit(" "), F.replace("words", F.lit(" "), F.lit("  ")), F.lit(" "))
    # A rule's two groups of keywords share no word.
    found = F.when(F.size("have") > 1, arrays.bind(normal, run)).otherwise(F.array().cast(f"array<{DETECTION}>"))
    # Arrays of one, exploded: the only way to have a value once that later columns use several times.
    once = one.select(key, "n_words", F.explode(F.array(found)).alias("detections"))
    return once.select(key, "n_words", "detections", F.when(F.size("detections") > 0, _standing(F.col("detections"))).otherwise(F.col("detections")).alias("standing"))


def licenses_report(docs: DataFrame) -> DataFrame:
    """The digest columns of the query."""
    rows = find_licenses(docs)
    base = F.filter("detections", lambda d: d["base"])
    labels = lambda found: F.transform(found, lambda d: d["label"])
    listed = lambda found: F.array_join(F.sort_array(F.array_distinct(found)), ",")
    return rows.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda d: d["start"])).cast("long").alias("first_word"),
        F.array_max(F.transform(base, lambda d: d["start"])).cast("long").alias("last_word"),
        listed(labels(base)).alias("base_labels"),
        listed(F.concat(labels(base), labels(F.col("standing")))).alias("labels"),
        F.coalesce(F.array_max(F.transform("standing", lambda d: d["score"])), F.lit(0.0)).alias("score"),
    )
