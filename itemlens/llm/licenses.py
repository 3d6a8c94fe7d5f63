"""Licence recognition by sentence rules.

A text is cut into sentences; each is normalised (lower case, one space between words, marks dropped, British spelling and
comment signs folded) and mapped to the identifier of the first known licence sentence whose pattern it matches in full.
The identifiers of a document, in order, form a sequence, and the ordered rules are matched against it: a rule names a
licence by consecutive identifiers, takes its matches out, and leaves the rest to later rules. So a whole licence text is
recognised before its single sentences are, and a sentence counts for one licence. Identifiers that no rule takes make the
document ``unknown`` beside what was found.

A sentence ends at a closing mark or a blank line (one with only a comment sign is blank), so it may run over several
lines. A line that is a known sentence by itself stands for itself, as a one-line notice does; the lines between such lines
are matched joined, from the start of any of them. Licence words in the middle of a wrapped sentence ("copyright notice,
...", "distributed under the License ...") count only where the joined lines are no other known sentence.

Only sentences that hold a licence word are looked at. Everything is DataFrame functions, without a shuffle. Patterns are
written so that matching takes time linear in a sentence of any length (see ``linear``). ``SQL`` cuts at every line break: it gives the same rows where each notice stands on one line, and doesn't know wrapped ones.

Null and empty texts have no sentences; null keys, repeated rows and repeated keys are documents of their own; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Where ``SQL`` cuts: closing marks and line breaks.
SENTENCE_END = "[.!?;:]+[\\x20\\t]+|[.!?;:]*[\\x20\\t]*[\\r\\n]+"
SIGNS = "#*/%;!>|-"
#: Closing marks, if they don't open a line as comment signs do, and blank lines.
RUN_END = (
    "[.!?;:](?<![\\r\\n][\\x20\\t]{0,40}[.!?;:])(?<![.!?;:]{2})[.!?;:]*[\\x20\\t\\r\\n]+"
    f"|(?<![\\x20\\t])[\\x20\\t]*+(?:\\r\\n|\\r(?!\\n)|\\n)[\\x20\\t]*+[{SIGNS}]*+[\\x20\\t]*+[\\r\\n]+"
)
LINE_END = "(?<![\\x20\\t])[\\x20\\t]*+[\\r\\n]+"
#: Words without which a text holds no known sentence.
HINT = (
    "(?i)licen[cs]e|copyright|permission|redistribut|warrant|reserved|public domain|gpl|creative commons|free software"
    "|\\x20cc[- ]by|cc0|general public|hereby granted|as is|liab|contributors"
)
#: The same words where a line may end between them.
WRAPPED_HINT = HINT.replace("[- ]", "[-\\x20]").replace(" ", f"[\\s{SIGNS}]+").replace("[-\\x20]", "[- ]")

# Known licence sentences after normalisation, first match wins; wording as in the published licences.
SENTENCES = (
    ("mit_grant", "permission is hereby granted free of charge to any person obtaining a copy of this software .*"),
    ("mit_notice", "the above copyright notice and this permission notice .*shall be included in all copies.*"),
    ("isc_grant", "permission to use copy modify and/or distribute this software for any purpose with or without fee is hereby granted.*"),
    ("as_is_software", "the software is provided as is .*"),
    ("bsd_intro", "redistribution and use in source and binary forms with or without modification are permitted.*"),
    ("bsd_source", "(1 )?redistributions of source code must retain .*"),
    ("bsd_binary", "(2 )?redistributions in binary form must reproduce .*"),
    ("bsd_endorse", "(3 )?neither the names? of .* may be used to endorse or promote products .*"),
    ("bsd_as_is", "this software is provided by the copyright holders and contributors as is .*"),
    ("no_liability", "in no event shall .* be liable .*"),
    ("apache_may_not", "you may not use this file except in compliance with the license"),
    ("apache_copy", "you may obtain a copy of the license at.*"),
    ("apache_unless", "unless required by applicable law or agreed to in writing .*"),
    ("apache_2", "(this .*|the .*)?(licensed|released|distributed|available) under (the terms of )?(the )?apache (software )?license(,? version)? ?v?2(\\.0)?( the license)?.*"),
    ("agpl_3", ".*(licensed|released|distributed|available|redistribute it) .*(gnu )?(affero general public license|agpl).*3.*"),
    ("lgpl", ".*(licensed|released|distributed|available|redistribute it) .*(gnu )?(lesser general public license|lgpl).*"),
    ("gpl_3", ".*(licensed|released|distributed|available|redistribute it) .*(gnu general public license|gnu gpl|gpl).*3.*"),
    ("gpl_2", ".*(licensed|released|distributed|available|redistribute it) .*(gnu general public license|gnu gpl|gpl).*2.*"),
    ("gpl_useful", ".*distributed in the hope that it will be useful.*"),
    ("gpl_received", "you should have received a copy of the gnu .*general public license.*"),
    ("mpl_2", ".*(subject to the terms of|licensed under|released under) the mozilla public license.*2(\\.0)?.*"),
    ("mit_named", "(this .*|the .*)?(licensed|released|distributed|available) under (the terms of )?the mit license.*"),
    ("bsd_named", "(this .*|the .*)?(licensed|released|distributed|available) under (the terms of )?(the |a )?([23]-clause )?bsd(-style)? license.*"),
    ("cc_by_nc", "(this .*|the .*)?(licensed|released|distributed|available) under (a |the )?(cc|creative commons)[ -](by-nc(-sa|-nd)?|attribution-noncommercial.*).*"),
    ("cc_by_sa", "(this .*|the .*)?(licensed|released|distributed|available) under (a |the )?(cc|creative commons)[ -](by-sa|attribution-sharealike.*).*"),
    ("cc_by", "(this .*|the .*)?(licensed|released|distributed|available) under (a |the )?(cc|creative commons)[ -](by|attribution).*"),
    ("cc_zero", "(.* )?(cc0(-1\\.0| 1\\.0)?( .*)?|creative commons zero.*|dedicated to the public domain.*)"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("reserved", "(.* )?all rights reserved"),
    ("copyright", "copyright (c )?.*"),
    ("other_license", "(this .*|the .*)?(licensed|released|distributed|available) under .*license.*"),
)

# Licences by consecutive identifiers, in the order in which the rules are tried; "?" may be missing.
RULES = (
    ("MIT", ("mit_grant", "mit_notice", "as_is_software?", "no_liability?")),
    ("ISC", ("isc_grant", "as_is_software?", "no_liability?")),
    ("BSD-3-Clause", ("bsd_intro", "bsd_source", "bsd_binary", "bsd_endorse", "bsd_as_is?", "no_liability?")),
    ("BSD-2-Clause", ("bsd_intro", "bsd_source", "bsd_binary", "bsd_as_is?", "no_liability?")),
    ("Apache-2.0", ("apache_2", "apache_may_not?", "apache_copy?", "apache_unless?")),
    ("AGPL-3.0", ("agpl_3", "gpl_useful?", "gpl_received?")),
    ("LGPL", ("lgpl", "gpl_useful?", "gpl_received?")),
    ("GPL-3.0", ("gpl_3", "gpl_useful?", "gpl_received?")),
    ("GPL-2.0", ("gpl_2", "gpl_useful?", "gpl_received?")),
    ("MPL-2.0", ("mpl_2",)),
    ("MIT", ("mit_named",)),
    ("BSD", ("bsd_named",)),
    ("CC-BY-NC", ("cc_by_nc",)),
    ("CC-BY-SA", ("cc_by_sa",)),
    ("CC-BY", ("cc_by",)),
    ("CC0-1.0", ("cc_zero",)),
    ("Unlicense", ("unlicense",)),
    ("all-rights-reserved", ("copyright?", "reserved")),
    ("copyright-notice", ("copyright",)),
)

#: A line that may be the middle of a sentence, as ``other_license`` may.
MIDDLE = "^copyright (?:notices?|holders?|owners?|licenses?|laws?|statements?|interest|and|or)(?: .*)?$"
#: Tried on joined lines only where no line of them is known by itself.
LAST = ("reserved", "copyright", "other_license")


def rule_pattern(parts: tuple[str, ...]) -> str:
    """A rule as a pattern over a sequence of identifiers, each written between ``<`` and ``>``."""
    return "".join(f"(?:<{p[:-1]}>)?" if p.endswith("?") else f"<{p}>" for p in parts)


def normalised(sentence: Column) -> Column:
    """Lower case; words, version numbers and the signs inside them, with one space between."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(sentence), "licence", "license"), "[^a-z0-9./+-]+", " ")
    return F.regexp_replace(plain, "^[ ./*#-]+|(?<![ ./*#-])[ ./*#-]+$", "")


#: What may stand before a sentence that names a licence.
LEAD = "(this .*|the .*)?"


def _gaps(pattern: str) -> list[str]:
    """The pattern cut at every ``.*`` outside of groups."""
    out, depth, at, start = [], 0, 0, 0
    while at < len(pattern):
        depth += (pattern[at] == "(") - (pattern[at] == ")")
        if not depth and pattern.startswith(".*", at):
            out.append(pattern[start:at])
            at = start = at + 2
        else:
            at += 1
    return [*out, pattern[start:]]


def linear(pattern: str, joined: bool) -> str:
    """A sentence's pattern that is matched in time linear in the sentence, from its start or, ``joined``, the start of any of
    its lines, to its end.

    Between gaps that hold anything, the first place of each part leaves most room for the next, so it is enough: each part
    with the gap before it is an atomic group that takes its first place and isn't tried again.
    """
    lead, body = (True, pattern.removeprefix(LEAD)) if pattern.startswith(LEAD) else (False, pattern)
    parts = _gaps(body)
    start = "^(?:.*?\\n)??" if joined else "^"
    if len(parts) == 1 or parts[-1]:  # one place only, or a part that must be the end
        if lead:
            return f"{start}(?:this|the) .*?{body}$|{'(?:^|\\n)' if joined else '^'}{body}$"
        return f"{'(?:^|\\n)' if joined and not body.startswith('(.* )?') else '^'}(?:{body})$"
    later = "".join(f"(?>.*?(?:{p}))" for p in parts[1:-1]) + ".*$"
    if not parts[0]:
        return f"^{later}"
    if not lead:
        return f"(?>{start}(?:{parts[0]})){later}"
    ways = (f"(?>{start}(?:this|the) ).*?{parts[0]}", f"{'(?:^|\\n)' if joined else '^'}{parts[0]}")
    if len(parts) > 2:
        ways = (f"(?>{start}(?:this|the) )(?>.*?(?:{parts[0]}))", f"(?>{start}(?:{parts[0]}))")
    return "|".join(w + later for w in ways)


def _over_lines(pattern: str) -> str:
    """A sentence's pattern over lines with a line feed between, from the start of any line to the end of the last."""
    spaced = linear(pattern, True).replace("[ -]", "[_-]").replace(" ", "[_]").replace("_", " \\n")
    return f"(?s){spaced}"


def _first(s: Column, patterns: list[tuple[str, str]]) -> Column:
    """The name of the first of ``patterns`` that is found in ``s``."""
    name, pattern = patterns[0]
    out = F.when(s.rlike(pattern), name)
    for name, pattern in patterns[1:]:
        out = out.when(s.rlike(pattern), name)
    return out


ALONE = [(name, linear(pattern, False)) for name, pattern in SENTENCES]
JOINED = [(name, _over_lines(pattern)) for name, pattern in SENTENCES if name not in LAST]
JOINED_LAST = [(name, _over_lines(pattern)) for name, pattern in SENTENCES if name in LAST]


def _lines(run: Column) -> Column:
    return F.transform(F.split(run, LINE_END), lambda x: F.struct(x.rlike(HINT).alias("hint"), normalised(x).alias("plain")))


def _marked(line: Column) -> Column:
    """The line; if it is known, ``<1>=name<1>``, or, where it may be the middle of a sentence, the line and ``<2>name``;
    <1> and <2> are control characters, which no normalised line holds."""
    name, plain = line["name"], line["plain"]
    middle = (name == "other_license") | ((name == "copyright") & plain.rlike(MIDDLE))
    known = F.when(middle, F.concat(plain, F.lit("\x02"), name)).otherwise(F.concat(F.lit("\x01="), name, F.lit("\x01")))
    return F.when(name.isNull(), plain).otherwise(known)


def _names(group: Column) -> Column:
    """The identifiers of one known line, or of the lines between two of them."""
    own = F.regexp_extract_all(group["marked"], F.lit("\x02(\\w+)"), F.lit(1))
    joined_last = F.array_compact(F.array(F.when(group["several"], _first(group["body"], JOINED_LAST))))
    names = F.when(group["marked"].startswith("="), F.array(F.ltrim(group["marked"], F.lit("="))))
    names = names.when(group["joined"].isNotNull(), F.array(group["joined"]))
    return names.when(F.size(own) > 0, own).otherwise(joined_last)


def _sentences(text: Column) -> Column:
    """The identifiers of the known sentences of a text, in order."""
    runs = F.transform(F.filter(F.split(text, RUN_END), lambda s: s.rlike(WRAPPED_HINT)), _lines)
    name = lambda x: F.when(x["hint"], _first(x["plain"], ALONE))
    runs = F.transform(runs, lambda r: F.transform(r, lambda x: F.struct(x["plain"].alias("plain"), name(x).alias("name"))))
    groups = F.flatten(F.transform(runs, lambda r: F.split(F.array_join(F.transform(r, _marked), "\n"), "\x01")))
    body = lambda g: F.regexp_replace(F.regexp_replace(g, "\x02\\w+", ""), "^\n+|\n+$", "")
    groups = F.transform(groups, lambda g: F.struct(g.alias("marked"), body(g).alias("body")))
    groups = F.transform(groups, lambda g: F.struct(g["marked"].alias("marked"), g["body"].alias("body"), g["body"].contains("\n").alias("several")))
    joined = lambda g: F.when(g["several"], _first(g["body"], JOINED))
    groups = F.transform(groups, lambda g: F.struct(*(g[c].alias(c) for c in ("marked", "body", "several")), joined(g).alias("joined")))
    return F.flatten(F.transform(groups, _names))


def recognise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its key as ``doc_id``, ``sentences`` (identifiers in order), ``licenses`` (names, sorted and
    distinct) and ``unknown`` (whether identifiers are left that no rule takes)."""
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), body.alias("text"))
    none = F.array().cast("array<string>")
    rows = rows.select("doc_id", F.when(F.col("text").rlike(WRAPPED_HINT), _sentences(F.col("text"))).otherwise(none).alias("sentences"))
    rows = rows.select("doc_id", "sentences", F.array_join(F.transform("sentences", lambda s: F.concat(F.lit("<"), s, F.lit(">"))), "").alias("rest"))
    hits = []
    for k, (name, parts) in enumerate(RULES):
        pattern = rule_pattern(parts)
        hits.append(f"hit_{k}")
        rows = rows.select(
            "*", F.when(F.col("rest").rlike(pattern), name).alias(hits[-1]), F.regexp_replace("rest", pattern, "").alias("left")
        )
        rows = rows.drop("rest").withColumnRenamed("left", "rest")
    return rows.select(
        "doc_id", "sentences", F.array_sort(F.array_distinct(F.array_compact(F.array(*hits)))).alias("licenses"), (F.col("rest") != "").alias("unknown")
    )


def op6(docs: DataFrame) -> DataFrame:
    """Licences of every document: number of known sentences, their identifiers, the licences, and what is left over."""
    return recognise(docs).select(
        "doc_id",
        F.size("sentences").cast("bigint").alias("n_sentences"),
        F.array_join("sentences", ",").alias("sentence_ids"),
        F.array_join("licenses", ",").alias("licenses"),
        F.col("unknown").alias("has_unknown"),
    )


def _sql() -> str:
    """The same rules in DuckDB SQL."""
    q = lambda s: "'" + s.replace("'", "''") + "'"
    named = " ".join(f"WHEN regexp_matches(p, {q(f'^(?:{pattern})$')}) THEN {q(name)}" for name, pattern in SENTENCES)
    steps, before = [], "seq"
    for k, (name, parts) in enumerate(RULES):
        p = q(rule_pattern(parts))
        steps.append(
            f"r{k} AS (SELECT * EXCLUDE (rest, found), regexp_replace(rest, {p}, '', 'g') AS rest, "
            f"CASE WHEN regexp_matches(rest, {p}) THEN list_append(found, {q(name)}) ELSE found END AS found FROM {before})"
        )
        before = f"r{k}"
    plain = (
        "regexp_replace(regexp_replace(regexp_replace(lower(s), 'licence', 'license', 'g'), '[^a-z0-9./+-]+', ' ', 'g'), "
        "'^[ ./*#-]+|[ ./*#-]+$', '', 'g')"
    )
    return f"""WITH cut AS (SELECT doc_id, CASE WHEN regexp_matches(coalesce(text, ''), {q(HINT)})
  THEN list_transform(list_filter(regexp_split_to_array(coalesce(text, ''), {q(SENTENCE_END)}), lambda s: regexp_matches(s, {q(HINT)})), lambda s: {plain})
  ELSE CAST([] AS VARCHAR[]) END AS plain FROM documents),
ids AS (SELECT doc_id, list_filter(list_transform(plain, lambda p: CASE {named} END), lambda x: x IS NOT NULL) AS ids FROM cut),
seq AS (SELECT doc_id, ids, array_to_string(list_transform(ids, lambda x: '<' || x || '>'), '') AS rest, CAST([] AS VARCHAR[]) AS found FROM ids),
{', '.join(steps)}
SELECT doc_id, CAST(len(ids) AS BIGINT) AS n_sentences, array_to_string(ids, ',') AS sentence_ids,
  array_to_string(list_sort(list_distinct(found)), ',') AS licenses, rest <> '' AS has_unknown FROM {before}"""


SQL = _sql()
