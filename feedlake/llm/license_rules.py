"""License scan by ordered signature rules, in DataFrame operations only.

Texts become words (A-Z lower-cased; runs of ASCII letters, digits and all characters beyond ASCII) between single spaces. Some
fifty licences times a handful of phrasings, and the notices, urls and identifiers written down one by one, give the signature rules, regular expressions over those words. A rule is tried
only where a keyword of its phrasing and one of its licence occur (plain substring tests that every match passes), and each of its matches is a detection: label, word interval,
confidence and tier. A detection is suppressed when its interval lies within one of a better or equal tier that
comes before it (tier, then longer, then label). What is kept gives labels and score.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlake.llm.host_reputation import LOWER, UPPER
from feedlake.llm.rows import quoted

#: The base phrases and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Label, how the licence is written as words, keywords (every way of writing holds one of them). Version numbers are words of their own.
LICENSES = [
    ("afl-3", r"academic free licen[cs]e(?: v| version)? ?3(?: 0)?", "academic free"),
    ("agpl-3", r"(?:gnu )?(?:affero general public licen[cs]e|agpl)(?: v| version)? ?3(?: 0)?", "affero|agpl"),
    ("apache-1", r"apache(?: software)?(?: licen[cs]e)?(?: version)? 1 [01]", "apache"),
    ("apache-2", r"apache(?: licen[cs]e)?(?: v| version)? ?2(?: 0)?", "apache"),
    ("artistic-2", r"artistic(?: licen[cs]e)?(?: version)? 2(?: 0)?", "artistic"),
    ("bsd-2", r"(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)", "bsd"),
    ("bsd-3", r"(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd)", "bsd"),
    ("bsd-4", r"(?:bsd 4 clause|4 clause bsd|original bsd)", "bsd"),
    ("bsl-1", r"boost software licen[cs]e(?: version)? 1(?: 0)?", "boost software"),
    ("busl-1", r"(?:business source licen[cs]e|busl)(?: version)? 1(?: 1)?", "business source|busl"),
    ("cc-by", r"(?:cc by|creative commons attribution)(?: [1-4] [05])?(?: international| unported)?", "cc by|creative commons"),
    ("cc-by-nc", r"(?:cc by nc|creative commons attribution noncommercial)(?: [1-4] [05])?(?: international| unported)?", "cc by nc|creative commons"),
    ("cc-by-nc-nd", r"(?:cc by nc nd|creative commons attribution noncommercial noderivatives)(?: [1-4] [05])?", "cc by nc|creative commons"),
    ("cc-by-nc-sa", r"(?:cc by nc sa|creative commons attribution noncommercial sharealike)(?: [1-4] [05])?", "cc by nc|creative commons"),
    ("cc-by-nd", r"(?:cc by nd|creative commons attribution noderivatives)(?: [1-4] [05])?", "cc by nd|creative commons"),
    ("cc-by-sa", r"(?:cc by sa|creative commons attribution sharealike)(?: [1-4] [05])?", "cc by sa|creative commons"),
    ("cc0", r"(?:cc0|creative commons zero)(?: 1 0)?(?: universal)?", "cc0|creative commons"),
    ("cddl-1", r"(?:common development and distribution licen[cs]e|cddl)(?: version)?(?: 1 [01])?", "common development|cddl"),
    ("cecill-2", r"cecill(?: version)? 2(?: [01])?", "cecill"),
    ("cpl-1", r"common public licen[cs]e(?: version)? 1(?: 0)?", "common public"),
    ("ecl-2", r"educational community licen[cs]e(?: version)? 2(?: 0)?", "educational"),
    ("elastic-2", r"elastic licen[cs]e(?: version)? 2(?: 0)?", "elastic"),
    ("epl-1", r"(?:eclipse public licen[cs]e|epl)(?: v| version)? ?1(?: 0)?", "eclipse|epl"),
    ("epl-2", r"(?:eclipse public licen[cs]e|epl)(?: v| version)? ?2(?: 0)?", "eclipse|epl"),
    ("eupl-1", r"(?:european union public licen[cs]e|eupl)(?: v| version)? ?1(?: [0-2])?", "european union|eupl"),
    ("gfdl-1", r"(?:gnu free documentation licen[cs]e|gfdl)(?: v| version)? ?1(?: [1-3])?", "free documentation|gfdl"),
    ("gpl-2", r"(?:gnu )?(?:general public licen[cs]e|gpl)(?: v| version)? ?2(?: 0)?", "general public|gpl"),
    ("gpl-3", r"(?:gnu )?(?:general public licen[cs]e|gpl)(?: v| version)? ?3(?: 0)?", "general public|gpl"),
    ("isc", r"isc", "isc"),
    ("lgpl-2", r"(?:gnu )?(?:lesser general public licen[cs]e|lgpl)(?: v| version)? ?2(?: [01])?", "lesser general|lgpl"),
    ("lgpl-3", r"(?:gnu )?(?:lesser general public licen[cs]e|lgpl)(?: v| version)? ?3(?: 0)?", "lesser general|lgpl"),
    ("lppl-1", r"(?:latex project public licen[cs]e|lppl)(?: version)?(?: 1 [0-3][abc]?)?", "latex|lppl"),
    ("mit", r"mit", "mit"),
    ("mit-0", r"mit (?:0|no attribution)", "mit"),
    ("mpl-1", r"(?:mozilla public licen[cs]e|mpl)(?: v| version)? ?1(?: [01])?", "mozilla|mpl"),
    ("mpl-2", r"(?:mozilla public licen[cs]e|mpl)(?: v| version)? ?2(?: 0)?", "mozilla|mpl"),
    ("ms-pl", r"(?:microsoft public licen[cs]e|ms pl)", "microsoft public|ms pl"),
    ("ms-rl", r"(?:microsoft reciprocal licen[cs]e|ms rl)", "microsoft reciprocal|ms rl"),
    ("ncsa", r"(?:university of illinois ncsa|ncsa open source)", "ncsa"),
    ("odbl-1", r"(?:open database licen[cs]e|odbl)(?: v| version)?(?: ?1 0)?", "open database|odbl"),
    ("ofl-1", r"(?:sil open font licen[cs]e|ofl)(?: version)?(?: 1 [01])?", "open font|ofl"),
    ("osl-3", r"open software licen[cs]e(?: version)? 3(?: 0)?", "open software"),
    ("pddl-1", r"(?:public domain dedication and licen[cs]e|pddl)(?: v| version)?(?: ?1 0)?", "public domain|pddl"),
    ("php-3", r"php(?: licen[cs]e)?(?: version)? 3(?: 0[01]?)?", "php"),
    ("postgresql", r"postgresql", "postgresql"),
    ("psf-2", r"(?:python software foundation|psf)(?: licen[cs]e)?(?: version)?(?: 2(?: 0)?)?", "python|psf"),
    ("sspl-1", r"(?:server side public licen[cs]e|sspl)(?: version)?(?: 1 0)?", "server side|sspl"),
    ("unlicense", r"(?:the unlicense|unlicense)", "unlicense"),
    ("upl-1", r"universal permissive licen[cs]e(?: version)?(?: 1 0)?", "universal permissive"),
    ("wtfpl", r"wtfpl", "wtfpl"),
    ("x11", r"x11", "x11"),
    ("zlib", r"zlib", "zlib"),
    ("zpl-2", r"(?:zope public licen[cs]e|zpl)(?: version)? 2(?: [01])?", "zope|zpl"),
]

#: Phrasing around a name, keywords (every match holds one of them), tier (1 is best), confidence.
PHRASINGS = [
    (r" spdx licen[cs]e identifier NAME(?: only| or later)?(?= )", "spdx", 1, 1.0),
    (r" licen[cs]ed(?: to you)? under (?:the )?(?:terms of (?:the )?)?(?:conditions of (?:the )?)?NAME(?: licen[cs]e)?(?= )", " under ", 2, 0.95),
    (r" (?:released|distributed|available|published|provided|covered) under (?:the )?(?:terms of (?:the )?)?NAME(?: licen[cs]e)?(?= )", " under ", 2, 0.9),
    (r" (?:subject to|governed by) (?:the )?(?:terms of (?:the )?)?NAME(?: licen[cs]e)?(?= )", " subject to | governed by ", 2, 0.85),
    (r" licen[cs]e NAME(?= )", "licen", 3, 0.7),
    (r" (?:the )?NAME licen[cs]e(?: text| agreement| terms)?(?= )", "licen", 3, 0.6),
]

#: Names that are common words or the names of programs, and what may not stand before "licence NAME" if it is to mean them.
BARE = {"isc", "mit", "postgresql", "x11", "zlib"}
NO_ARTICLE = r"(?<! (?:a|an|any|each|every|her|his|its|my|no|our|that|the|their|this|your))"

#: Sentences of the licences and of their usual notices, addresses, and identifiers that are nothing else: label, regex,
#: keywords (every match holds one of them), tier, confidence.
NOTICES = [
    ("agpl-3", r" gnu affero general public licen[cs]e as published by the free software foundation either version 3(?= )", "as published by the free software", 1, 1.0),
    ("gpl-2", r" gnu general public licen[cs]e as published by the free software foundation(?: either)? version 2(?= )", "as published by the free software", 1, 1.0),
    ("gpl-2", r" gnu general public licen[cs]e version 2 as published by the free software foundation(?= )", "as published by the free software", 1, 1.0),
    ("gpl-3", r" gnu general public licen[cs]e as published by the free software foundation(?: either)? version 3(?= )", "as published by the free software", 1, 1.0),
    ("lgpl-2", r" gnu (?:lesser|library) general public licen[cs]e as published by the free software foundation(?: either)? version 2(?: 1)?(?= )", "as published by the free software", 1, 1.0),
    ("lgpl-3", r" gnu lesser general public licen[cs]e as published by the free software foundation(?: either)? version 3(?= )", "as published by the free software", 1, 1.0),
    ("mit", r" permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files(?= )", "hereby granted", 1, 1.0),
    ("bsl-1", r" permission is hereby granted free of charge to any person or organization obtaining a copy of the software(?= )", "hereby granted", 1, 1.0),
    ("isc", r" permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted(?= )", "hereby granted", 1, 1.0),
    ("postgresql", r" permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted(?= )", "hereby granted", 1, 1.0),
    ("bsd", r" redistribution and use in source and binary forms with or without modification are permitted(?= )", "redistribution and use", 1, 1.0),
    ("bsd-3", r" may be used to endorse or promote products derived from this software without specific prior written permission(?= )", "endorse or promote", 1, 1.0),
    ("bsd-4", r" all advertising materials mentioning features or use of this software must display(?= )", "advertising materials", 1, 1.0),
    ("zlib", r" in no event will the authors be held liable for any damages arising from the use of this software(?= )", "held liable for any damages", 1, 1.0),
    ("unlicense", r" this is free and unencumbered software released into the public domain(?= )", "unencumbered", 1, 1.0),
    ("wtfpl", r" do what the fuck you want to public licen[cs]e(?= )", "you want to public", 1, 1.0),
    ("cc0", r" has dedicated the work to the public domain by waiving all of his or her rights(?= )", "to the public domain", 1, 1.0),
    ("cc0", r" waived all copyright and related or neighbou?ring rights(?= )", "waived all copyright", 1, 1.0),
    ("cc-by", r" creativecommons org licen[cs]es by [1-4] [05](?= )", "creativecommons org", 1, 1.0),
    ("cc-by-nc", r" creativecommons org licen[cs]es by nc [1-4] [05](?= )", "creativecommons org", 1, 1.0),
    ("cc-by-nc-nd", r" creativecommons org licen[cs]es by nc nd [1-4] [05](?= )", "creativecommons org", 1, 1.0),
    ("cc-by-nc-sa", r" creativecommons org licen[cs]es by nc sa [1-4] [05](?= )", "creativecommons org", 1, 1.0),
    ("cc-by-nd", r" creativecommons org licen[cs]es by nd [1-4] [05](?= )", "creativecommons org", 1, 1.0),
    ("cc-by-sa", r" creativecommons org licen[cs]es by sa [1-4] [05](?= )", "creativecommons org", 1, 1.0),
    ("cc0", r" creativecommons org publicdomain zero 1 0(?= )", "creativecommons org", 1, 1.0),
    ("apache-2", r" apache org licen[cs]es licen[cs]e 2 0(?= )", "apache org", 1, 1.0),
    ("gpl-2", r" gnu org licen[cs]es(?: old licen[cs]es)? gpl 2 0(?= )", "gnu org", 1, 1.0),
    ("gpl-3", r" gnu org licen[cs]es gpl 3 0(?= )", "gnu org", 1, 1.0),
    ("lgpl-2", r" gnu org licen[cs]es(?: old licen[cs]es)? lgpl 2 [01](?= )", "gnu org", 1, 1.0),
    ("lgpl-3", r" gnu org licen[cs]es lgpl 3 0(?= )", "gnu org", 1, 1.0),
    ("agpl-3", r" gnu org licen[cs]es agpl 3 0(?= )", "gnu org", 1, 1.0),
    ("mpl-2", r" mozilla org (?:en us )?mpl 2 0(?= )", "mozilla org", 1, 1.0),
    ("bsl-1", r" boost org licen[cs]e 1 0(?= )", "boost org", 1, 1.0),
    ("unlicense", r" unlicense org(?= )", "unlicense org", 1, 1.0),
    ("mit", r" opensource org licen[cs]es? mit(?= )", "opensource org", 1, 1.0),
    ("isc", r" opensource org licen[cs]es? isc(?= )", "opensource org", 1, 1.0),
    ("zlib", r" opensource org licen[cs]es? zlib(?= )", "opensource org", 1, 1.0),
    ("bsd-2", r" opensource org licen[cs]es? bsd 2 clause(?= )", "opensource org", 1, 1.0),
    ("bsd-3", r" opensource org licen[cs]es? bsd 3 clause(?= )", "opensource org", 1, 1.0),
    ("bsd-2", r" bsd 2 clause(?= )", "bsd", 3, 0.6),
    ("bsd-3", r" bsd 3 clause(?= )", "bsd", 3, 0.6),
    ("bsd-4", r" bsd 4 clause(?= )", "bsd", 3, 0.6),
    ("agpl-3", r" agpl 3 0 (?:only|or later)(?= )", "agpl", 3, 0.6),
    ("gpl-2", r" gpl 2 0 (?:only|or later)(?= )", "gpl", 3, 0.6),
    ("gpl-3", r" gpl 3 0 (?:only|or later)(?= )", "gpl", 3, 0.6),
    ("lgpl-2", r" lgpl 2 [01] (?:only|or later)(?= )", "lgpl", 3, 0.6),
    ("lgpl-3", r" lgpl 3 0 (?:only|or later)(?= )", "lgpl", 3, 0.6),
]


def signature_rules() -> list[tuple[str, str, str, str, int, float]]:
    """(label, regex, the phrasing's keywords, the licence's keywords, tier, confidence): every licence in every phrasing, and the notices."""
    rules = []
    for label, name, own in LICENSES:
        for p, key, tier, sure in PHRASINGS:
            guard = NO_ARTICLE if label in BARE and p.startswith(" licen[cs]e NAME") else ""
            rules.append((label, guard + p.replace("NAME", name), key, own, tier, sure))
    return rules + [(label, regex, key, key, tier, sure) for label, regex, key, tier, sure in NOTICES]


def canonical(text: Column) -> Column:
    """Words between single spaces, one space before the first and after the last; two spaces for a text without words."""
    low = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")), F.lit(" "))


def spaces(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))


def _phrase(c: Column, phrase: str) -> tuple[Column, Column, Column]:
    """(places, first word, last word) of a phrase in canonical words; neighbours may share a space."""
    key = f" {phrase} "
    has = F.contains(c, F.lit(key))
    first = spaces(F.substring(c, F.lit(1), F.instr(c, key))) - 1
    before = F.length(c) - F.length(F.substring_index(c, key, -1)) - len(key) + 1
    last = spaces(F.substring(c, F.lit(1), before)) - 1
    return F.when(has, F.regexp_count(c, F.lit(f" {phrase}(?= )"))).otherwise(0), F.when(has, first), F.when(has, last)


def _present(c: Column, keys: list[str]) -> Column:
    """Those of the keys (keywords between bars) of which a keyword occurs."""
    either = lambda key: reduce(or_, (F.contains(c, F.lit(k)) for k in key.split("|")))
    return F.array_compact(F.array(*(F.when(either(key), F.lit(key)) for key in sorted(set(keys)))))


def license_scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_words, n_base, first_word, last_word, base_labels, labels (arrays, sorted), score for every row.

    Null and empty texts have no words, places or labels and score 0. Repeated rows are scanned alike, null ids stay, extra
    columns are not read, an empty table gives no rows. Texts stay where they are read; only word intervals are shuffled,
    by row, to order and suppress detections.
    """
    names = ("label", "regex", "key", "own", "tier", "sure")
    signatures = signature_rules()
    rules = F.array(*(F.struct(*(F.lit(v).alias(n) for n, v in zip(names, r))) for r in signatures))
    c = F.col("c")
    rows = docs.select(F.col(quoted(id_col)).alias("doc_id"), F.monotonically_increasing_id().alias("row"), canonical(F.col(quoted(text))).alias("c"))
    found = [_phrase(c, p) for p in PHRASES]
    n_base = sum((f[0] for f in found[1:]), found[0][0]).cast("bigint")
    base = F.array_compact(F.array(*(F.when(f[0] > 0, F.lit(label)) for f, label in zip(found, PHRASES.values()))))
    present = _present(c, [key for _, _, key, *_ in signatures])
    rows = rows.select(
        "doc_id", "row", "c",
        F.when(F.trim(c) == "", 0).otherwise(spaces(c) - 1).cast("bigint").alias("n_words"),
        n_base.alias("n_base"),
        F.least(*(f[1] for f in found)).cast("bigint").alias("first_word"),
        F.greatest(*(f[2] for f in found)).cast("bigint").alias("last_word"),
        F.array_sort(F.array_distinct(base)).alias("base_labels"),
        present.alias("present"),
    )
    rows = rows.withColumn("named", F.when(F.size("present") > 0, _present(c, [own for _, _, _, own, *_ in signatures])))
    tried = F.when(
        F.size("named") > 0,
        F.filter(rules, lambda r: F.array_contains(F.col("present"), r["key"]) & F.array_contains(F.col("named"), r["own"]) & F.regexp_like(c, r["regex"])),
    )
    facts = ["doc_id", "row", "n_words", "n_base", "first_word", "last_word", "base_labels"]
    rows = rows.select(*facts, "c", F.explode_outer(tried).alias("r"))
    regex = F.col("r.regex")
    gaps = F.transform(F.split(c, regex, -1), spaces)
    sizes = F.transform(F.regexp_extract_all(c, regex, F.lit(0)), spaces)
    zipped = F.when(regex.isNotNull(), F.arrays_zip(F.slice(gaps, 1, F.size(sizes)).alias("gap"), sizes.alias("size")))
    rows = rows.select(*facts, F.col("r.label").alias("label"), F.col("r.tier").alias("tier"), F.col("r.sure").alias("sure"), regex.alias("regex"), F.posexplode_outer(zipped).alias("i", "z"))
    size = F.col("z").getField("size")
    run = Window.partitionBy("row", "regex").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum(F.col("z").getField("gap") + size).over(run)).withColumn("start", F.col("end") - size)
    # a detection that comes before (start, then longer, better tier, label) and ends no earlier contains it
    before = Window.partitionBy("row").orderBy("start", F.col("end").desc(), "tier", "label").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.coalesce(*(F.when(F.col("tier") == t, F.max(F.when(F.col("tier") <= t, F.col("end"))).over(before)) for t in (1, 2, 3)))
    rows = rows.withColumn("kept", F.col("label").isNotNull() & (reach.isNull() | (reach < F.col("end"))))
    firsts = [F.first(f).alias(f) for f in facts if f != "row"]
    out = rows.groupBy("row").agg(
        *firsts, F.collect_set(F.when(F.col("kept"), F.col("label"))).alias("more"), F.max(F.when(F.col("kept"), F.col("sure"))).alias("best")
    )
    return out.select(
        *[f for f in facts if f != "row"],
        F.array_sort(F.array_union("base_labels", "more")).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )
