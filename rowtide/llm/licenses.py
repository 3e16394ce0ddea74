"""Licence scan by sentences and rules, in DataFrame functions only.

A text is cut into sentences, these are normalised, and known ones get identifiers; the sequence of identifiers of a
document is then matched against rules in their order. A rule is a run of identifiers that stands for a licence; what an
earlier rule took, later ones do not see. All of it happens within a row, so nothing is shuffled.

A sentence that is not known as a whole is tried line by line, for notices that stand below a line without a full stop.
A line with an SPDX tag is an expression of identifiers; each is a sentence of its own, and an exception goes to the licence it
stands behind. Names of licences, in notices and in titles, are made from a list of families by rule. An empty table gives no rows.
A null or empty text has no sentences. Rows are treated by themselves; columns besides doc_id and text are left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.llm.common import table

# Texts of licence notices, in the form that `normalised` gives them.
SENTENCES = {
    "mit-title": "mit license mit",
    "mit-name": "under mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the software to deal in the software without restriction including without limitation the rights to use "
    "copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software "
    "is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of "
    "the software",
    "mit-as-is": "the software is provided as is without warranty of any kind express or implied including but not limited to the "
    "warranties of merchantability fitness for a particular purpose and noninfringement",
    "mit-liability": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether "
    "in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings "
    "in the software",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
    "provided that the above copyright notice and this permission notice appear in all copies",
    "isc-name": "under isc license",
    "bsd-name": "under bsd license",
    "bsd2-name": "under bsd 2-clause license",
    "bsd3-name": "under bsd 3-clause license",
    "bsd-redistribution": "redistribution and use in source and binary forms with or without modification are permitted provided that "
    "the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following "
    "disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following "
    "disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission",
    "bsd-as-is": "this software is provided by the copyright holders and contributors as is and any express or implied warranties "
    "including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "apache2-name": "under apache license version 2.0",
    "apache2-short": "under apache 2.0 license",
    "apache2-grant": "under apache license version 2.0 the license you may not use this file except in compliance with the license",
    "apache2-copy": "you may obtain a copy of the license at http www.apache.org licenses license-2.0",
    "apache2-as-is": "unless required by applicable law or agreed to in writing software distributed under the license is distributed "
    "on an as is basis without warranties or conditions of any kind either express or implied",
    "apache2-see": "see the license for the specific language governing permissions and limitations under the license",
    "gpl2-name": "under gnu general public license version 2",
    "gpl3-name": "under gnu general public license version 3",
    "lgpl3-name": "under gnu lesser general public license version 3",
    "agpl3-name": "under gnu affero general public license version 3",
    "gpl2-later-grant": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
    "license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl3-later-grant": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
    "license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied "
    "warranty of merchantability or fitness for a particular purpose",
    "gpl-see": "see the gnu general public license for more details",
    "mpl2-terms": "this source code form is subject to the terms of the mozilla public license v 2.0",
    "mpl2-name": "under mozilla public license version 2.0",
    "cc0-name": "under cc0 1.0",
    "cc-by-name": "under cc by 4.0",
    "cc-by-sa-name": "under cc by-sa 4.0",
    "cc-by-nc-name": "under cc by-nc 4.0",
    "cc-by-nd-name": "under cc by-nd 4.0",
    "cc-by-nc-sa-name": "under cc by-nc-sa 4.0",
    "cc-by-nc-nd-name": "under cc by-nc-nd 4.0",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "rights-reserved": "all rights reserved",
}
# Identifiers of licences with the names that notices give them, in normal form. Of those with a version the name is
# without it; the version is what the identifier ends in.
FAMILIES = {
    "0BSD": ("zero-clause bsd license", "bsd zero clause license"),
    "AFL-3.0": ("academic free license",),
    "Apache-1.1": ("apache software license",),
    "Apache-2.0": ("apache license", "apache software license", "apache public license"),
    "Artistic-1.0": ("artistic license",),
    "Artistic-2.0": ("artistic license",),
    "BlueOak-1.0.0": ("blue oak model license",),
    "BSD-2-Clause": ("simplified bsd license", "freebsd license", "2-clause bsd license", "two-clause bsd license"),
    "BSD-3-Clause": ("new bsd license", "modified bsd license", "revised bsd license", "3-clause bsd license", "three-clause bsd license"),
    "BSD-4-Clause": ("original bsd license", "4-clause bsd license", "bsd 4-clause license"),
    "BSL-1.0": ("boost software license",),
    "CC0-1.0": ("cc0", "creative commons zero", "creative commons cc0"),
    "CDDL-1.0": ("common development and distribution license", "cddl"),
    "CDDL-1.1": ("common development and distribution license", "cddl"),
    "CECILL-2.1": ("cecill free software license agreement", "cecill"),
    "CPL-1.0": ("common public license",),
    "ECL-2.0": ("educational community license",),
    "EPL-1.0": ("eclipse public license", "epl"),
    "EPL-2.0": ("eclipse public license", "epl"),
    "EUPL-1.1": ("european union public license", "eupl"),
    "EUPL-1.2": ("european union public license", "eupl"),
    "HPND": ("historical permission notice and disclaimer",),
    "IPL-1.0": ("ibm public license",),
    "ISC": ("isc license",),
    "LPPL-1.3c": ("latex project public license", "lppl"),
    "MIT": ("mit license", "expat license", "mit expat license", "mit open source license", "mit software license"),
    "MIT-0": ("mit no attribution license", "mit no attribution"),
    "MPL-1.1": ("mozilla public license", "mpl"),
    "MPL-2.0": ("mozilla public license", "mpl"),
    "MS-PL": ("microsoft public license",),
    "MS-RL": ("microsoft reciprocal license",),
    "MulanPSL-2.0": ("mulan psl", "mulan permissive software license"),
    "NCSA": ("university of illinois ncsa open source license", "ncsa license"),
    "ODbL-1.0": ("open database license", "odc open database license", "open data commons open database license", "odbl"),
    "OFL-1.1": ("sil open font license", "open font license", "ofl"),
    "OSL-3.0": ("open software license",),
    "PHP-3.01": ("php license",),
    "PostgreSQL": ("postgresql license",),
    "PSF-2.0": ("python software foundation license", "psf license"),
    "Ruby": ("ruby license",),
    "Unlicense": ("unlicense",),
    "UPL-1.0": ("universal permissive license", "upl"),
    "Vim": ("vim license",),
    "W3C": ("w3c software notice and license", "w3c license"),
    "WTFPL": ("wtfpl", "do what the fuck you want to public license"),
    "X11": ("x11 license", "mit x11 license"),
    "Zlib": ("zlib license", "zlib libpng license"),
}
# Licences of the GNU project, which come with later versions or without, by the start of their identifiers.
GNU = {
    "GPL": (("gnu general public license", "gpl", "gnu gpl"), ("1.0", "2.0", "3.0")),
    "LGPL": (("gnu lesser general public license", "gnu library general public license", "lgpl", "gnu lgpl"), ("2.0", "2.1", "3.0")),
    "AGPL": (("gnu affero general public license", "agpl", "gnu agpl"), ("1.0", "3.0")),
    "GFDL": (("gnu free documentation license", "gfdl"), ("1.1", "1.2", "1.3")),
}
# Exceptions that stand behind WITH in an expression.
EXCEPTIONS = (
    "Autoconf-exception-3.0", "Bison-exception-2.2", "Classpath-exception-2.0", "Font-exception-2.0", "GCC-exception-3.1",
    "Linux-syscall-note", "LLVM-exception", "OpenSSL-exception", "Swift-exception",
)
# Titles of licence texts, in normal form, with what they stand for.
TITLES = {
    "apache license version 2.0 january 2004": "Apache-2.0",
    "apache license version 2.0 january 2004 http www.apache.org licenses": "Apache-2.0",
    "apache license version 2.0 january 2004 https www.apache.org licenses": "Apache-2.0",
    "gnu general public license version 1 february 1989": "GPL-1.0-only",
    "gnu general public license version 2 june 1991": "GPL-2.0-only",
    "gnu general public license version 3 29 june 2007": "GPL-3.0-only",
    "gnu lesser general public license version 2.1 february 1999": "LGPL-2.1-only",
    "gnu lesser general public license version 3 29 june 2007": "LGPL-3.0-only",
    "gnu library general public license version 2 june 1991": "LGPL-2.0-only",
    "gnu affero general public license version 3 19 november 2007": "AGPL-3.0-only",
    "gnu free documentation license version 1.3 3 november 2008": "GFDL-1.3-only",
    "mozilla public license version 2.0": "MPL-2.0",
    "mozilla public license version 1.1": "MPL-1.1",
    "eclipse public license v 1.0": "EPL-1.0",
    "eclipse public license v 2.0": "EPL-2.0",
    "boost software license version 1.0 august 17th 2003": "BSL-1.0",
    "sil open font license version 1.1 26 february 2007": "OFL-1.1",
    "european union public license v 1.2": "EUPL-1.2",
    "do what the fuck you want to public license version 2 december 2004": "WTFPL",
    "creative commons legal code cc0 1.0 universal": "CC0-1.0",
}
#: How an identifier is given by itself; behind it may be several, with AND, OR and WITH between them.
TAG = "spdx-license-identifier "
#: An identifier of a sentence that says a licence by itself, with the licence behind it, and one of an exception.
IS, WITH = "is:", "with:"
#: Ordered: of rules that begin alike the longer comes first. A notice of rights alone names no licence and is no rule.
RULES = (
    ("MIT", ("mit-title", "mit-grant", "mit-notice", "mit-as-is", "mit-liability")),
    ("MIT", ("mit-name", "mit-grant", "mit-notice", "mit-as-is", "mit-liability")),
    ("MIT", ("mit-grant", "mit-notice", "mit-as-is", "mit-liability")),
    ("MIT", ("mit-title", "mit-grant", "mit-notice")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("ISC", ("isc-name", "isc-grant")),
    ("ISC", ("isc-grant",)),
    ("BSD-3-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-as-is")),
    ("BSD-2-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-as-is")),
    ("BSD-3-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary")),
    ("Apache-2.0", ("apache2-grant", "apache2-copy", "apache2-as-is", "apache2-see")),
    ("Apache-2.0", ("apache2-grant", "apache2-copy")),
    ("Apache-2.0", ("apache2-grant",)),
    ("GPL-2.0-or-later", ("gpl2-later-grant", "gpl-hope", "gpl-see")),
    ("GPL-3.0-or-later", ("gpl3-later-grant", "gpl-hope", "gpl-see")),
    ("GPL-2.0-or-later", ("gpl2-later-grant",)),
    ("GPL-3.0-or-later", ("gpl3-later-grant",)),
    ("MIT", ("mit-title",)),
    ("MIT", ("mit-name",)),
    ("ISC", ("isc-name",)),
    ("BSD-2-Clause", ("bsd2-name",)),
    ("BSD-3-Clause", ("bsd3-name",)),
    ("BSD", ("bsd-name",)),
    ("Apache-2.0", ("apache2-name",)),
    ("Apache-2.0", ("apache2-short",)),
    ("GPL-2.0-only", ("gpl2-name",)),
    ("GPL-3.0-only", ("gpl3-name",)),
    ("LGPL-3.0-only", ("lgpl3-name",)),
    ("AGPL-3.0-only", ("agpl3-name",)),
    ("MPL-2.0", ("mpl2-terms",)),
    ("MPL-2.0", ("mpl2-name",)),
    ("CC0-1.0", ("cc0-name",)),
    ("CC-BY-4.0", ("cc-by-name",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-name",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-name",)),
    ("CC-BY-ND-4.0", ("cc-by-nd-name",)),
    ("CC-BY-NC-SA-4.0", ("cc-by-nc-sa-name",)),
    ("CC-BY-NC-ND-4.0", ("cc-by-nc-nd-name",)),
    ("Unlicense", ("unlicense",)),
)
#: Replacements that normalise a lower-cased sentence, in this order. The patterns mean the same in Java's and RE2's syntax.
STEPS = (
    (r"creative commons attribution", "cc by"),
    (r"-noncommercial", "-nc"),
    (r"-sharealike", "-sa"),
    (r"-noderivatives|-noderivs", "-nd"),
    (r"licence", "license"),
    (r"([0-9])\+", "{1}-or-later"),
    (r"[^a-z0-9.\-]+", " "),
    (r"(^| )[.\-]+|[.\-]+( |$)", " "),
    (r" +", " "),
    (r"^ | $", ""),
    (r"^the (mit license mit)$", "{1}"),
    (
        r"^((this|the) (work|software|project|program|code|library|file|document|content|package|text|page|database|dataset|font|module|plugin|repository|book|image|material) is )?"
        r"(licensed|released|distributed|published|provided|available|made available) under ",
        "under ",
    ),
    (r"^under (the )?terms of ", "under "),
    (r"^under (the|a|an) ", "under "),
    (
        r"^(under .+?),? (see|found in|as found in|which can be found in|included in|as described in|as stated in) "
        r"(the )?((accompanying|included|enclosed|attached) )?(file )?(named )?(license|copying|readme|notice)[a-z0-9. \-]*$",
        "{1}",
    ),
    (r"^(under .*[0-9].*?) or (at your option )?(any )?(later|newer|higher)( version)?s?$", "{1} or later"),
    (r"^under (.*) v ?([0-9.]+) or later$", "under {1} version {2} or later"),
    (r"^under (.*) v ?([0-9.]+)( license)?$", "under {1} version {2}"),
    (r"^under (gnu general public license|gpl|gnu gpl) (version )?([23])(\.0)?$", "under gnu general public license version {3}"),
    (r"^under apache license 2\.0$", "under apache license version 2.0"),
    (r"^under (cc by[a-z\-]*) ([0-9.]+)( international)?( license)?$", "under {1} {2}"),
)
#: Words that STEPS can put into a sentence that had none of them, and ends that they can put to a word. All else in a normal form
#: stands in the lower-cased text as it is, between the same borders: the steps, and the cutting into sentences and lines, join
#: no letters or digits that something parted.
MADE = {"cc", "by", "license", "gnu", "general", "public", "version", "or", "later"}
ENDS = "-nc|-sa|-nd|-or-later"
BORDER, LINE = "\x02", "\x01"


def hint_of(known: Iterable[str]) -> str:
    """A pattern found in every lower-cased text with a sentence that ``normalised`` turns into one of ``known``: of each the
    word license or the letters cc in the forms that the steps make them of, or the longest word that they can't make."""

    said = {"licen[cs]e|gpl"}  # license, and gpl as the steps make license of it
    words: set[str] = set()
    behind: set[str] = set()  # words that only the steps' fillers part from "under"
    for sentence in known:
        tokens = sentence.split()
        if "license" in sentence or "gpl" in sentence:
            continue
        if "cc" in tokens:
            words |= {"cc", "creative"}
            continue
        if tokens[:1] == ["under"] and (first := re.split(ENDS, " ".join(tokens[1:2]))[0]) and first not in MADE:
            behind.add(first)
            continue
        rare = {re.split(ENDS, w)[0] for w in tokens} - MADE
        # a number alone says little, and less do the words that most begin or end with
        best = max(rare, default="", key=lambda w: (w not in ("under", "only"), not re.fullmatch("[0-9.]*", w), len(w), w))
        if not best:
            return ""  # found in every text
        words.add(best)

    def one_of(words: set[str]) -> str:
        # a word is found where another one begins it
        words = {w for w in words if not any(w.startswith(v) and not w[len(v)].isalnum() for v in words - {w})}
        return f"(?:{'|'.join(sorted(map(re.escape, words)))})(?![a-z0-9])"

    if words:
        said.add(f"(?<![a-z0-9]){one_of(words)}")
    if behind:
        said.add(f"(?<![a-z0-9])under[^a-z0-9]+(?:(?:the|terms|of|an?)[^a-z0-9]+)*{one_of(behind)}")
    return "|".join(sorted(said))


def _normal(sentence: str) -> str:
    """``normalised`` of ASCII text."""
    out = sentence.lower()
    for pattern, replacement in STEPS:
        out = re.sub(pattern, re.sub(r"\{(\d)\}", r"\\\1", replacement), out)
    return out


def _named() -> dict[str, str]:
    """Normal sentences that say a licence by its name or its identifier, with ``IS`` or ``WITH`` and what they say."""
    out = dict(TITLES)

    def add(license_id: str, *names: str) -> None:
        for name in names:
            out.setdefault(_normal(name), license_id)

    def add_id(license_id: str, written: str) -> None:
        written = written.lower()
        add(license_id, TAG + written, f"under {written}", f"under {written} license", f"license {written}")

    def add_versions(license_id: str, name: str, version: str, later: str = "") -> None:
        for v in {version, version.removesuffix(".0")}:
            for form in (f"{name} version {v}", f"{name} {v}", f"{name}-{v}"):
                add(license_id, f"under {form}{later}")

    for start, (names, versions) in GNU.items():
        for version in versions:
            whole = f"{start}-{version}"
            for license_id, later in ((f"{whole}-only", ""), (f"{whole}-only", " only"), (f"{whole}-or-later", " or later")):
                for name in names:
                    add_versions(license_id, name, version, later)
            for license_id in (f"{whole}-only", f"{whole}-or-later"):
                add_id(license_id, license_id)
            add_id(f"{whole}-only", whole)  # as it was written before
    for license_id, names in FAMILIES.items():
        add_id(license_id, license_id)
        name, _, version = license_id.rpartition("-")
        for said in names:
            if name and version[:1].isdigit() and "." in version:
                add_versions(license_id, said, version)
                add(license_id, f"under {said} {version} license")
            else:
                add(license_id, f"under {said}", *([] if "license" in said else [f"under {said} license"]))
    for kind in ("by", "by-sa", "by-nc", "by-nd", "by-nc-sa", "by-nc-nd"):
        for version in ("2.0", "2.5", "3.0", "4.0"):
            license_id = f"CC-{kind.upper()}-{version}"
            add_id(license_id, license_id)
            add(license_id, f"under cc {kind} {version}")
    says = {sentence: IS + license_id for sentence, license_id in out.items()}
    return says | {TAG + e.lower(): WITH + e for e in EXCEPTIONS}


#: All known sentences with their identifiers.
KNOWN = _named() | {sentence: name for name, sentence in SENTENCES.items()}
#: Texts without it are not cut up, and sentences without it not normalised.
HINT = hint_of(KNOWN)


def _java(replacement: str) -> str:
    return replacement.replace("{", "$").replace("}", "")


def normalised(sentence: Column) -> Column:
    out = F.lower(sentence)
    for pattern, replacement in STEPS:
        out = F.regexp_replace(out, pattern, _java(replacement))
    return out


def sentences(text: Column) -> Column:
    """Sentences end with a mark before a blank, or with an empty line; lines within one are still told apart."""
    text = F.regexp_replace(F.regexp_replace(text, r"[\x00-\x08\x0E-\x1F]", " "), r"[ \t]*\r?\n[ \t#*/;>|%-]*", LINE)
    text = F.regexp_replace(text, f"{LINE}{LINE}+", BORDER)
    text = F.regexp_replace(text, f"([.!?])[ \t{LINE}]+", f"$1{BORDER}")
    return F.split(text, BORDER)


def scan(
    docs: DataFrame,
    known: Mapping[str, str] | None = None,
    rules: Sequence[tuple[str, Sequence[str]]] = RULES,
    hint: str | None = None,
) -> DataFrame:
    """(doc_id, n_sentences, sentence_ids, licenses) of each row: known sentences in their order, and licences in theirs,
    both joined by commas.

    ``known`` has sentences by their identifiers; by default these are ``KNOWN``. Rules are tried in their order; what they leave is
    a licence where the identifier says it by itself, and an exception goes to the licence before it. ``hint`` is a pattern that
    lower-cased texts with known sentences have; by default it is told from ``known``.
    """
    names_of = KNOWN if known is None else {sentence: name for name, sentence in known.items()}
    hint = hint_of(names_of) if hint is None else hint
    ids = F.create_map(*(F.lit(x) for pair in names_of.items() for x in pair))
    name_of = lambda s: F.try_element_at(ids, s)

    def of_line(n: Column) -> Column:
        terms = F.split(F.substr(n, F.lit(len(TAG) + 1)), " (or|and|with) ")
        terms = F.transform(terms, lambda t: name_of(F.concat(F.lit(TAG), t)))
        return F.when(n.startswith(TAG), terms).otherwise(F.array(name_of(n)))

    def names(sentence: Column) -> Column:
        whole = name_of(normalised(sentence))
        lines = F.flatten(F.transform(F.transform(F.split(sentence, LINE), normalised), of_line))
        return F.when(whole.isNotNull(), F.array(whole)).otherwise(lines)

    hinted = F.when(F.lower("text").rlike(hint), F.lower("text"))
    found = F.coalesce(F.flatten(F.transform(F.filter(sentences(hinted), lambda s: s.rlike(hint)), names)), F.array())
    docs = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    docs = docs.select("doc_id", F.filter(found, lambda name: name.isNotNull()).alias("names"))
    left = F.array_join(F.transform("names", lambda name: F.concat(F.lit("["), name, F.lit("]"))), "")
    for license_id, run in rules:
        left = F.replace(left, F.lit("".join(f"[{name}]" for name in run)), F.lit(f"<{license_id}>"))
    left = F.regexp_replace(left, rf"\[{IS}([^\]]*)\]", "<$1>")
    left = F.regexp_replace(left, rf">\[{WITH}([^\]]*)\]", " WITH $1>")
    docs = docs.select("doc_id", "names", left.alias("left"))
    return docs.select(
        "doc_id", F.size("names").cast("long").alias("n_sentences"), F.array_join("names", ",").alias("sentence_ids"),
        F.array_join(F.regexp_extract_all("left", F.lit("<([^>]*)>"), F.lit(1)), ",").alias("licenses"),
    )


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def _sql() -> str:
    """The same in DuckDB's SQL."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"

    def normal(sentence: str) -> str:
        out = f"lower({sentence})"
        for pattern, replacement in STEPS:
            to = replacement.replace("{", "\\").replace("}", "")
            out = f"regexp_replace({out}, {quote(pattern)}, {quote(to)}, 'g')"
        return out

    left = "names"
    left = f"coalesce(list_aggregate(list_transform({left}, lambda n: '[' || n || ']'), 'string_agg', ''), '')"
    for license_id, run in RULES:
        left = f"replace({left}, {quote(''.join(f'[{n}]' for n in run))}, '<{license_id}>')"
    left = f"regexp_replace({left}, '\\[{IS}([^\\]]*)\\]', '<\\1>', 'g')"
    left = f"regexp_replace({left}, '>\\[{WITH}([^\\]]*)\\]', ' WITH \\1>', 'g')"
    values = ", ".join(f"({quote(s)}, {quote(n)})" for s, n in KNOWN.items())
    return rf"""
WITH known(sentence, name) AS (VALUES {values}),
cut AS (
  SELECT doc_id, unnest(string_split(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text,
    '[\x00-\x08\x0E-\x1F]', ' ', 'g'), '[ \t]*\r?\n[ \t#*/;>|%-]*', chr(1), 'g'), '\x01\x01+', chr(2), 'g'),
    '([.!?])[ \t\x01]+', '\1' || chr(2), 'g'), chr(2))) AS sentence,
    generate_subscripts(string_split(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text,
    '[\x00-\x08\x0E-\x1F]', ' ', 'g'), '[ \t]*\r?\n[ \t#*/;>|%-]*', chr(1), 'g'), '\x01\x01+', chr(2), 'g'),
    '([.!?])[ \t\x01]+', '\1' || chr(2), 'g'), chr(2)), 1) AS pos
  FROM documents
), whole AS (
  SELECT c.doc_id, c.pos, 0 AS line, c.sentence, k.name FROM cut c LEFT JOIN known k ON {normal("c.sentence")} = k.sentence
), lines AS (
  SELECT doc_id, pos, unnest(string_split(sentence, chr(1))) AS sentence,
    generate_subscripts(string_split(sentence, chr(1)), 1) AS line
  FROM whole WHERE name IS NULL
), normal_lines AS (SELECT doc_id, pos, line, {normal("sentence")} AS sentence FROM lines
), terms AS (
  SELECT doc_id, pos, line, unnest(string_split_regex(substr(sentence, {len(TAG) + 1}), ' (or|and|with) ')) AS term,
    generate_subscripts(string_split_regex(substr(sentence, {len(TAG) + 1}), ' (or|and|with) '), 1) AS place
  FROM normal_lines WHERE starts_with(sentence, '{TAG}')
), named AS (
  SELECT doc_id, pos, line, 0 AS place, name FROM whole WHERE name IS NOT NULL
  UNION ALL
  SELECT l.doc_id, l.pos, l.line, 0, k.name FROM normal_lines l JOIN known k ON l.sentence = k.sentence
    AND NOT starts_with(l.sentence, '{TAG}')
  UNION ALL
  SELECT t.doc_id, t.pos, t.line, t.place, k.name FROM terms t JOIN known k ON '{TAG}' || t.term = k.sentence
), listed AS (SELECT doc_id, list(name ORDER BY pos, line, place) AS names FROM named GROUP BY doc_id),
matched AS (SELECT doc_id, names, {left} AS rest FROM listed)
SELECT d.doc_id, coalesce(len(names), 0)::BIGINT AS n_sentences, coalesce(array_to_string(names, ','), '') AS sentence_ids,
  coalesce(array_to_string(regexp_extract_all(rest, '<([^>]*)>', 1), ','), '') AS licenses
FROM documents d LEFT JOIN matched m ON d.doc_id = m.doc_id
"""


OP9_SQL = _sql()
