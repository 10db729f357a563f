"""License scans: ordered signature rules over the words of a text (built-in functions only).

A text becomes lower-case words between single spaces. Each rule is a hand-written word
pattern with a keyword, a priority and a weight; a rule's pattern is tried only on texts that
contain its keyword. Overlapping detections are resolved by interval containment: one whose
words all lie inside another's longer interval is dropped; of two with the same interval the
one of higher priority stays.

Null and empty texts have no words and no detections. Ties between equal intervals of equal
priority go to the earlier rule. Repeated rows are scanned one by one; no row is joined or
moved, so every row keeps its result and there is no group to be skewed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseledger.llm.words import table

# Phrases that always count, with their labels.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

# Label, keyword, name pattern, SPDX pattern, address pattern. Words are lower case and
# separated by one space; dots and dashes of names and addresses are spaces here.
FAMILIES = (
    ("mit", "mit", "mit", "mit", "opensource org licenses mit"),
    ("mit-0", "mit", "mit no attribution", "mit 0", "opensource org licenses mit 0"),
    ("apache-2", "apache", "apache(?: software)?(?: license)?(?: version)? 2(?: 0)?", "apache 2 0", "apache org licenses license 2 0"),
    ("apache-1.1", "apache", "apache(?: software)?(?: license)?(?: version)? 1 1", "apache 1 1", "apache org licenses license 1 1"),
    ("apache-1.0", "apache", "apache(?: software)?(?: license)?(?: version)? 1 0", "apache 1 0", "apache org licenses license 1 0"),
    ("gpl-2", "gnu", "gnu (?:general public license|gpl)(?: gpl)?(?: version| v)? (?:2|v2)(?: 0)?", "gpl 2 0(?: only| or later)?", "gnu org licenses (?:old licenses )?gpl 2 0"),
    ("gpl-3", "gnu", "gnu (?:general public license|gpl)(?: gpl)?(?: version| v)? (?:3|v3)(?: 0)?", "gpl 3 0(?: only| or later)?", "gnu org licenses gpl 3 0"),
    ("gpl", "gnu", "gnu (?:general public license|gpl)", "gpl", "gnu org (?:licenses|copyleft) gpl"),
    ("lgpl-2.1", "lesser", "gnu lesser general public license(?: lgpl)?(?: version| v)? (?:2 1|v2 1)", "lgpl 2 1(?: only| or later)?", "gnu org licenses (?:old licenses )?lgpl 2 1"),
    ("lgpl-3", "lesser", "gnu lesser general public license(?: lgpl)?(?: version| v)? (?:3|v3)(?: 0)?", "lgpl 3 0(?: only| or later)?", "gnu org licenses lgpl 3 0"),
    ("lgpl", "general", "gnu (?:lesser|library) general public license", "lgpl", "gnu org (?:licenses|copyleft) lgpl"),
    ("agpl-3", "affero", "gnu affero general public license(?: version| v)? (?:3|v3)(?: 0)?", "agpl 3 0(?: only| or later)?", "gnu org licenses agpl 3 0"),
    ("agpl", "affero", "(?:gnu )?affero general public license", "agpl", "gnu org licenses agpl"),
    ("fdl", "documentation", "gnu free documentation license", "gfdl 1 [123](?: only| or later)?", "gnu org licenses fdl"),
    ("bsd-2", "bsd", "(?:2|two) clause bsd|simplified bsd|bsd 2 clause", "bsd 2 clause", "opensource org licenses bsd 2 clause"),
    ("bsd-3", "bsd", "(?:3|three) clause bsd|new bsd|modified bsd|bsd 3 clause", "bsd 3 clause", "opensource org licenses bsd 3 clause"),
    ("bsd-4", "bsd", "(?:4|four) clause bsd|original bsd|bsd 4 clause", "bsd 4 clause", "spdx org licenses bsd 4 clause"),
    ("bsd-0", "bsd", "zero clause bsd|0 clause bsd", "0bsd", "opensource org licenses 0bsd"),
    ("bsd", "bsd", "bsd(?: style)?", "bsd", "opensource org licenses bsd license"),
    ("isc", "isc", "isc", "isc", "opensource org licenses isc"),
    ("mpl-1.1", "mozilla", "mozilla public license(?: version| v)? 1 1", "mpl 1 1", "mozilla org mpl 1 1"),
    ("mpl-2", "mozilla", "mozilla public license(?: version| v)? 2(?: 0)?", "mpl 2 0", "mozilla org mpl 2 0"),
    ("mpl", "mozilla", "mozilla public license", "mpl", "mozilla org mpl"),
    ("epl-1", "eclipse", "eclipse public license(?: version| v)? 1(?: 0)?", "epl 1 0", "eclipse org legal epl v10"),
    ("epl-2", "eclipse", "eclipse public license(?: version| v)? 2(?: 0)?", "epl 2 0", "eclipse org legal epl 2 0"),
    ("epl", "eclipse", "eclipse public license", "epl", "eclipse org legal epl"),
    ("cddl", "common", "common development and distribution license", "cddl 1 [01]", "opensource org licenses cddl1"),
    ("cpl", "common", "common public license", "cpl 1 0", "opensource org licenses cpl1"),
    ("artistic-2", "artistic", "artistic license(?: version| v)? 2(?: 0)?", "artistic 2 0", "opensource org licenses artistic license 2 0"),
    ("artistic", "artistic", "artistic license", "artistic 1 0", "opensource org licenses artistic license"),
    ("zlib", "zlib", "zlib(?: libpng)?", "zlib", "opensource org licenses zlib"),
    ("libpng", "libpng", "libpng", "libpng(?: 2 0)?", "libpng org pub png src libpng license"),
    ("boost", "boost", "boost software license", "bsl 1 0", "boost org license 1 0"),
    ("unlicense", "unlicense", "unlicense", "unlicense", "unlicense org"),
    ("wtfpl", "wtfpl", "wtfpl", "wtfpl", "wtfpl net"),
    ("python", "python", "python(?: software foundation)?", "(?:python|psf) 2 0", "docs python org 3 license"),
    ("ruby", "ruby", "ruby", "ruby", "ruby lang org en about license"),
    ("php", "php", "php license(?: version| v)? 3 01|php", "php 3 0 ?1?", "php net license"),
    ("postgresql", "postgresql", "postgresql", "postgresql", "postgresql org about licence"),
    ("openssl", "openssl", "openssl", "openssl", "openssl org source license"),
    ("ms-pl", "microsoft", "microsoft public license", "ms pl", "opensource org licenses ms pl"),
    ("ms-rl", "microsoft", "microsoft reciprocal license", "ms rl", "opensource org licenses ms rl"),
    ("eupl", "european", "european union public licence(?: v)?(?: 1 [12])?", "eupl 1 [12]", "joinup ec europa eu .{0,60}eupl"),
    ("osl-3", "open", "open software license(?: version| v)? 3(?: 0)?", "osl 3 0", "opensource org licenses osl 3 0"),
    ("afl-3", "academic", "academic free license(?: version| v)? 3(?: 0)?", "afl 3 0", "opensource org licenses afl 3 0"),
    ("ofl", "font", "sil open font license(?: version| v)?(?: 1 1)?", "ofl 1 [01]", "scripts sil org ofl"),
    ("ncsa", "illinois", "university of illinois(?: ncsa)?(?: open source)?", "ncsa", "opensource org licenses ncsa"),
    ("upl", "universal", "universal permissive license", "upl 1 0", "oss oracle com licenses upl"),
    ("odbl", "database", "open database license", "odbl 1 0", "opendatacommons org licenses odbl"),
    ("pddl", "domain", "public domain dedication and license", "pddl 1 0", "opendatacommons org licenses pddl"),
    ("cc0", "cc0", "cc0(?: 1 0)?(?: universal)?", "cc0 1 0", "creativecommons org publicdomain zero"),
    ("cc-by", "cc", "cc by(?: [1234] [05])?", "cc by [1234] [05]", "creativecommons org licenses by [1234]"),
    ("cc-by-sa", "cc", "cc by sa(?: [1234] [05])?", "cc by sa [1234] [05]", "creativecommons org licenses by sa"),
    ("cc-by-nd", "cc", "cc by nd(?: [1234] [05])?", "cc by nd [1234] [05]", "creativecommons org licenses by nd"),
    ("cc-by-nc", "cc", "cc by nc(?: [1234] [05])?", "cc by nc [1234] [05]", "creativecommons org licenses by nc [1234]"),
    ("cc-by-nc-sa", "cc", "cc by nc sa(?: [1234] [05])?", "cc by nc sa [1234] [05]", "creativecommons org licenses by nc sa"),
    ("cc-by-nc-nd", "cc", "cc by nc nd(?: [1234] [05])?", "cc by nc nd [1234] [05]", "creativecommons org licenses by nc nd"),
)

# Further names of families: label, keyword, name pattern.
NAMES = (
    ("cc-by", "commons", "creative commons attribution(?: [1234] [05])?"),
    ("cc-by-sa", "commons", "creative commons attribution share ?alike(?: [1234] [05])?"),
    ("cc-by-nd", "commons", "creative commons attribution no ?deriv(?:ative)?s(?: [1234] [05])?"),
    ("cc-by-nc", "commons", "creative commons attribution non ?commercial(?: [1234] [05])?"),
    ("cc-by-nc-sa", "commons", "creative commons attribution non ?commercial share ?alike(?: [1234] [05])?"),
    ("cc-by-nc-nd", "commons", "creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: [1234] [05])?"),
)

# Notices recognised by their own words: label, keyword, pattern.
NOTICES = (
    ("mit", "permission", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("isc", "permission", "permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("bsd-3", "endorse", "neither the name of .{1,80}? may be used to endorse or promote products derived from this software"),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("apache-2", "compliance", "you may not use this file except in compliance with the license"),
    ("gpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("agpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("mpl-2", "subject", "subject to the terms of the mozilla public license v 2 0"),
    ("boost", "permission", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("zlib", "warranty", "this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("wtfpl", "public", "do what the (?:fuck|f ck) you want to public license"),
)


def rules() -> list[tuple[str, str, str, int, float]]:
    """(label, keyword, pattern, priority, weight), the earlier rule first.

    Whatever a pattern matches holds the keyword as a word.
    """
    out = [(label, key, f"(?:spdx )?license identifier {spdx}", 90, 0.99) for label, key, _, spdx, _ in FAMILIES]
    out = [(label, "identifier", pattern, p, w) for label, _, pattern, p, w in out]
    out += [(label, key, pattern, 80, 0.95) for label, key, pattern in NOTICES]
    addresses = {label: url for label, _, _, _, url in FAMILIES}
    for label, key, name in [f[:3] for f in FAMILIES] + list(NAMES):
        url = addresses.pop(label, None)
        out += [
            (label, key, f"(?:licen[sc]ed|released|distributed|published|available|provided|covered) (?:under|by) (?:the )?(?:terms of )?(?:the )?(?:{name})(?: licen[sc]e)?", 70, 0.9),
            *([(label, url.split()[0], f"(?:https? )?(?:www )?{url}", 60, 0.85)] if url else []),
            (label, key, f"(?:under|by) (?:the )?(?:{name}) licen[sc]e", 50, 0.8),
            (label, key, f"licen[sc]e (?:is )?(?:the )?(?:{name})", 40, 0.7),
            (label, key, f"(?:the )?(?:{name}) licen[sc]e" if "licen" not in name else f"(?:the )?(?:{name})", 30, 0.6),
        ]
    out += [(label, phrase.split()[-1] if label != "apache-2" else "apache", phrase, 100, 0.97) for phrase, label in PHRASES]
    return [(label, f" {key} ", f" (?:{pattern})(?= )", p, w) for label, key, pattern, p, w in out]


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _detections(norm: Column, keys: Column) -> Column:
    """All detections of the rules whose keyword is among ``keys``, as words [start, stop)."""
    table_ = F.array(*[F.struct(F.lit(i).alias("rule"), F.lit(label).alias("label"), F.lit(key.strip()).alias("key"),
                                F.lit(pattern).alias("pattern"), F.lit(p).alias("priority"), F.lit(w).alias("weight"))
                       for i, (label, key, pattern, p, w) in enumerate(rules())])

    def places(rule: Column) -> Column:
        found = F.regexp_extract_all(norm, rule["pattern"], F.lit(0))
        gaps = F.split(norm, rule["pattern"], F.lit(-1))
        words = F.transform(found, _spaces)
        before = F.transform(gaps, _spaces)
        # Each match starts with its space; the words before it are the spaces before it.
        return F.transform(F.sequence(F.lit(0), F.size(found) - 1), lambda k: _let(
            F.aggregate(F.slice(before, 1, k + 1), F.lit(0), lambda a, x: a + x)
            + F.aggregate(F.slice(words, 1, k), F.lit(0), lambda a, x: a + x),
            lambda start: F.struct(
                start.alias("start"), (start + F.element_at(words, k + 1)).alias("stop"),
                rule["priority"].alias("priority"), rule["rule"].alias("rule"),
                rule["label"].alias("label"), rule["weight"].alias("weight"))))

    tried = F.filter(table_, lambda r: F.array_contains(keys, r["key"]) & F.rlike(norm, r["pattern"]))
    return F.flatten(F.transform(tried, places))


def _wins(a: Column, b: Column) -> Column:
    """b's interval holds a's, and b is the stronger."""
    inside = (b["start"] <= a["start"]) & (a["stop"] <= b["stop"])
    longer = (b["stop"] - b["start"]) > (a["stop"] - a["start"])
    earlier = (b["priority"] == a["priority"]) & (b["rule"] < a["rule"])
    return inside & (longer | (b["priority"] > a["priority"]) | earlier)


def _phrase_places(phrase: str, label: str) -> Column:
    """Where the phrase's words stand one after another."""
    parts = phrase.split()
    here = F.transform(F.col("words"), lambda w, i: F.when(
        (w == parts[0]) & (F.array_join(F.slice(F.col("words"), i + 1, len(parts)), " ") == phrase), i))
    found = F.transform(F.filter(here, lambda i: i.isNotNull()),
                        lambda i: F.struct(i.alias("start"), F.lit(label).alias("label")))
    return F.when(F.contains(F.col("norm"), F.lit(f" {phrase} ")), found).otherwise(
        F.array().cast("array<struct<start:int,label:string>>"))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: the id, n_words, base places and the surviving detections.

    Columns: id, n_words, base (places of the fixed phrases: start, label), detections (start,
    stop, priority, rule, label, weight). Texts without any keyword never meet a pattern.
    """
    # No phrase or rule has a letter that lower() makes from a character outside A-Z.
    norm = F.concat(F.lit(" "), F.regexp_replace(F.lower(F.coalesce(F.col(text_col).cast("string"), F.lit(""))),
                                                 r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "), F.lit(" "))
    norm = F.concat(F.lit(" "), F.trim(norm), F.lit(" "))
    base = F.flatten(F.array(*[_phrase_places(phrase, label) for phrase, label in PHRASES]))
    out = docs.select(F.col(id_col).alias(id_col), norm.alias("norm"))
    out = out.withColumn("norm", F.when(F.col("norm") == "  ", F.lit(" ")).otherwise(F.col("norm")))
    out = out.withColumn("n_words", (_spaces(F.col("norm")) - 1).cast("long")).withColumn("words", F.split(F.trim("norm"), " "))
    # The keywords of all rules, those of the fixed phrases among them, that are words of the text.
    keys = F.array(*[F.lit(key) for key in dict.fromkeys(key.strip() for _, key, _, _, _ in rules())])
    out = out.withColumn("keys", F.array_intersect(keys, "words")).withColumn("gate", F.size("keys") > 0)
    found = F.when(F.col("gate"), _detections(F.col("norm"), F.col("keys")))
    out = out.select(id_col, "n_words", F.when(F.col("gate"), base).alias("base"), found.alias("found"))
    kept = F.filter("found", lambda a: ~F.exists("found", lambda b: _wins(a, b)))
    return out.select(id_col, "n_words", F.coalesce("base", F.array().cast("array<struct<start:int,label:string>>")).alias("base"),
                      F.coalesce(kept, F.array().cast(
                          "array<struct<start:int,stop:int,priority:int,rule:int,label:string,weight:double>>")).alias("detections"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(table(spark, sf_dir, "documents"))
    base = F.transform("base", lambda b: b["label"])
    labels = F.array_union(base, F.transform("detections", lambda d: d["label"]))
    doubt = F.aggregate("detections", F.lit(1.0), lambda a, d: a * (1 - d["weight"]))
    first, last = (f(F.transform("base", lambda b: b["start"])).cast("long") for f in (F.array_min, F.array_max))
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), first.alias("first_word"),
        last.alias("last_word"), F.array_join(F.sort_array(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.sort_array(labels), ",").alias("labels"),
        F.round(1 - doubt, 9).alias("score"), F.size("detections").cast("long").alias("n_detections"))
