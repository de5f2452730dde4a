"""Licence scans by sentence rules.

A text is normalised: A-Z lower-cased, comment signs and list numbers at the
start of lines left out, every run of other characters than a-z and 0-9 one
space. A sentence is bounded by ``. ! ?`` before white space, by line ends, and
by ``; :`` before white space. Line ends and ``; :`` may also stand inside a
known sentence, so that one that is wrapped over lines, in a comment or not, is
found; ``. ! ?`` may not. Known licence sentences have identifiers, and the
longest that fits at a place is taken; a document becomes the sequence of its
sentences' identifiers, ``-`` for what stands between them. Licence rules are
sequences of identifiers, tried in order: a rule that occurs claims its
identifiers wherever it stands, so that a longer licence isn't read as a
shorter one as well.

All of it is Spark expressions on each row, without a shuffle.

Cases: null and empty texts hold no licence; a licence that repeats is named
once; a sentence that belongs to no complete rule counts in ``n_sentences``
alone; an empty table gives an empty result; extra columns are not read. The
SQL twin cuts at every line end: it says the same for sentences on one line
and doesn't know wrapped ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text

# Licence sentences, normalised, by identifier.
SENTENCES = {
    "apache-by": "licensed under the apache license version 2 0",
    "apache-you": "licensed under the apache license version 2 0 the license",
    "apache-not": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "mit-by": "released under the mit license",
    "mit-under": "this project is licensed under the mit license",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "gpl3-work": "this work is licensed under the gnu general public license version 3",
    "gpl3-either": "either version 3 of the license or at your option any later version",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"
                " as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied"
                " warranty of merchantability or fitness for a particular purpose",
    "gpl-see": "see the gnu general public license for more details",
    "bsd-redistribution": "redistribution and use in source and binary forms with or without modification are permitted provided"
                          " that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following"
                  " disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-names": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products"
                 " derived from this software without specific prior written permission",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "cc-by": "licensed under cc by 4 0",
    "cc-by-sa": "licensed under cc by sa 4 0",
    "cc0": "released under cc0 1 0",
}

# Licences and the sequences of sentences that state them, in the order in which they are tried.
RULES = (
    ("GPL-3.0", ("gpl-free", "gpl-hope", "gpl-see")),
    ("GPL-3.0", ("gpl-free",)),
    ("GPL-3.0", ("gpl3-work",)),
    ("BSD-3-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary")),
    ("Apache-2.0", ("apache-you", "apache-not", "apache-copy")),
    ("Apache-2.0", ("apache-by",)),
    ("MIT", ("mit-by",)),
    ("MIT", ("mit-under",)),
    ("MIT", ("mit-notice",)),
    ("CC-BY-NC-4.0", ("cc-by-nc",)),
    ("CC-BY-SA-4.0", ("cc-by-sa",)),
    ("CC-BY-4.0", ("cc-by",)),
    ("CC0-1.0", ("cc0",)),
)

_CUT = r"[.!?]+[ \t\r]+|[\r\n]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


_HARD, _SOFT, _KNOWN = "\x01", "\x02", "\x03"
#: Comment signs and list numbers at the start of a line.
_LEAD = r"(?<![^\r\n])[^a-z0-9\r\n]*+(?:(?:rem|dnl)[ \t]+)?(?:[0-9]{1,2}[.)][ \t]+)?"


def sequence(text: F.Column, sentences: dict[str, str] = SENTENCES) -> F.Column:
    """The identifiers of a text's sentences, each between two spaces:
    ``" -  mit-by  - "`` and so on, ready to be searched."""
    t = F.translate(text, _UPPER + _HARD + _SOFT + _KNOWN, _LOWER + "   ")
    for pattern, by in ((_LEAD, ""), (r"[.!?]+[ \t\r\n]+", _HARD), (r"[;:]+[ \t]+|[;:]*[\r\n]+", _SOFT), (r"[^a-z0-9\x01\x02]+", " "),
                        (r"(?<![ \x02])[ \x02]*+\x01[ \x01\x02]*", _HARD), (r" ?\x02[ \x02]*", _SOFT)):
        t = F.regexp_replace(t, pattern, by)
    t = F.concat(F.lit(_HARD), F.regexp_replace(t, r"^ +| +$|[;:]+$", ""), F.lit(_HARD))
    longest = sorted(sentences.values(), key=len, reverse=True)
    any_known = r"(?<=[\x01\x02])(?:" + "|".join(x.replace(" ", r"[ \x02]") for x in longest) + r")(?=[\x01\x02])"
    known = F.create_map(*[F.lit(x) for i, x in sentences.items() for x in (x, i)])
    ids = F.transform(F.split(F.regexp_replace(t, any_known, _KNOWN + "$0" + _KNOWN), _KNOWN), lambda x: F.coalesce(
        F.try_element_at(known, F.translate(x, _SOFT, " ")), F.when(x.rlike("[a-z]"), F.lit("-"))))
    return F.concat(F.lit(" "), F.array_join(F.filter(ids, lambda i: i.isNotNull()), "  "), F.lit(" "))


def found(seq: F.Column, rules=RULES) -> F.Column:
    """The licences whose rules occur in a sequence, in the rules' order."""
    names = []
    for name, ids in rules:
        rule = " " + "  ".join(ids) + " "
        names.append(F.when(F.contains(seq, F.lit(rule)), F.lit(name)))
        seq = F.replace(seq, F.lit(rule), F.lit(" - "))
    return F.array_distinct(F.filter(F.array(*names), lambda x: x.isNotNull()))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sentences: dict[str, str] = SENTENCES,
         rules=RULES) -> DataFrame:
    """``doc_id``, ``licences`` (joined by commas), ``n_sentences`` (known
    ones) of every row."""
    seq = id_and_text(docs, id_col, text_col).select("doc_id", sequence(F.col("text"), sentences).alias("seq"))
    known = F.size(F.filter(F.split("seq", " "), lambda x: (x != "") & (x != "-")))
    return seq.select("doc_id", F.array_join(found(F.col("seq"), rules), ",").alias("licences"), known.cast("long").alias("n_sentences"))


def oracle(sentences: dict[str, str] = SENTENCES, rules=RULES) -> str:
    """The same scan as DuckDB SQL."""
    known = ", ".join(f"'{s}': '{i}'" for i, s in sentences.items())
    plain = f"trim(regexp_replace(translate(s, '{_UPPER}', '{_LOWER}'), '[^a-z0-9]+', ' ', 'g'))"
    sql = (f"SELECT doc_id, ' ' || array_to_string(list_transform(regexp_split_to_array(coalesce(text, ''), '{_CUT}'), "
           f"lambda s: coalesce(MAP {{{known}}}[{plain}], '-')), '  ') || ' ' AS q0 FROM documents")
    parts = []
    for k, (name, ids) in enumerate(rules):
        rule = " " + "  ".join(ids) + " "
        sql = f"SELECT *, replace(q{k}, '{rule}', ' - ') AS q{k + 1} FROM ({sql})"
        parts.append(f"CASE WHEN contains(q{k}, '{rule}') THEN '{name}' END")
    order = list(dict.fromkeys(name for name, _ in rules))
    names = ", ".join(f"'{n}'" for n in order)
    return (f"SELECT doc_id, array_to_string(list_filter([{names}], lambda n: list_contains([{', '.join(parts)}], n)), ',') AS licences, "
            f"len(list_filter(string_split(q0, ' '), lambda x: x <> '' AND x <> '-')) AS n_sentences FROM ({sql})")
