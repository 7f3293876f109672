"""Known texts of common licences, as data for ``licenses.scan``.

``table`` adds to ``licenses.KNOWN`` short texts, notices made of names and phrases, and
digests of long texts. The registered query scans for all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from obsframe.llm.licenses import KNOWN, known_digests

_BSD_START = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met:")
_BSD_CONDITIONS = (
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer.",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
    "following disclaimer in the documentation and/or other materials provided with the distribution.",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission.",
)
_BSD_END = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT {who} OR CONTRIBUTORS BE LIABLE FOR ANY "
    "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
    "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
    "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_UNLICENSE = (
    "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, "
    "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
    "for any purpose, commercial or non-commercial, and by any means.\n\nIn jurisdictions that recognize copyright "
    "laws, the author or authors of this software dedicate any and all copyright interest in the software to the "
    "public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs "
    "and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and "
    "future rights to this software under copyright law.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF "
    "ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
    "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
    "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
    "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.\n\nFor more information, please refer to "
)

#: Names by which notices call a licence.
NAMES = {
    "MIT": ("MIT License", "MIT"),
    "ISC": ("ISC License", "ISC"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache 2.0"),
    "BSD-2-Clause": ("BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "3-Clause BSD License", "New BSD License"),
    "MPL-2.0": ("Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "MPL 2.0"),
    "Unlicense": ("Unlicense",),
    "CC0-1.0": ("CC0 1.0", "CC0 1.0 Universal", "Creative Commons CC0 1.0 Universal License"),
    **{f"{short}-{version}": (
        f"GNU {name}, version {version}", f"GNU {name} version {version}", f"GNU {name} v{version}",
        f"GNU {name}, version {version.removesuffix('.0')}", f"GNU {name} v{version.removesuffix('.0')}",
        f"{short} v{version.removesuffix('.0')}", f"{short}-{version}", f"{short} {version}")
       for short, name, versions in (
           ("GPL", "General Public License", ("2.0", "3.0")), ("LGPL", "Lesser General Public License", ("2.1", "3.0")),
           ("AGPL", "Affero General Public License", ("3.0",))) for version in versions},
    **{f"CC-{short}-{version}": (
        f"CC {short} {version}", f"CC-{short} {version}", f"Creative Commons {name} {version} International License",
        f"Creative Commons {name} {version} International", f"Creative Commons {name} {version} License",
        f"Creative Commons {name} {version}")
       for short, name in (
           ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"),
           ("BY-NC", "Attribution-NonCommercial"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
           ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")) for version in ("3.0", "4.0")},
}
PHRASES = tuple(
    f"{start} {by} under {article}" for start, by in (
        ("", "Licensed"), ("", "Released"), ("", "Distributed"), ("", "Available"),
        *((f"This {what} is", by) for what in ("work", "project", "software", "code", "file", "document", "article")
          for by in ("licensed", "released", "distributed", "available")))
    for article in ("", "the ", "a ", "an ", "the terms of the ")) + ("License: ",)

#: (licence, digest of ``licenses.whole_digest``) of the entire texts as their publishers give them.
LONG_TEXTS = (
    ("Apache-2.0", "adb6b124886c3992d58c349b38524541"),
    ("Apache-2.0", "d5a73f37915f5677de6fcd1a848765a5"),
    ("Apache-2.0", "ecb8762b65d75e162ae7a7112e2285cd"),
    ("Artistic-1.0", "a8b0fb0c6e43a3b36bdc159e59dbfd1e"),
    ("CC0-1.0", "93a180096f6cfcf2c0dd24f75c2eec48"),
    ("GFDL-1.2", "eafdbd3fd6ad83ba93ee32190290d7bf"),
    ("GFDL-1.3", "726881efb60deef866eb1e87ba5896cc"),
    ("GPL-1.0", "5eec7b5790959e349dcbaf8ca724488b"),
    ("GPL-1.0", "78f3b35da3d393ee93ecfeb7d20907e6"),
    ("GPL-1.0", "f9bdbdf2be484ced90e5d8d884a7bed9"),
    ("GPL-2.0", "0a1be7a79f9324c9f73ed406cab28e4b"),
    ("GPL-2.0", "42f2f51f3e726d001525877e3528c3d0"),
    ("GPL-2.0", "b73af68d56407814bb0960dcc4125f3d"),
    ("GPL-3.0", "03337ecd04584344766a0128066f5674"),
    ("GPL-3.0", "bf480e7e40d121cc52866fe1cc94d04f"),
    ("GPL-3.0", "c1d263ed7dad8374d032a647e169de1a"),
    ("LGPL-2.0", "74cf7fcef3b29a39165a795b2cad3a3a"),
    ("LGPL-2.0", "97832943be1e344d51af5aee1b658e4f"),
    ("LGPL-2.0", "c396ba2f94537628797123bc12cd2d6e"),
    ("LGPL-2.1", "3054b3781b1af43f906dc753acad15ee"),
    ("LGPL-2.1", "eaf6afb73fc860a002bfbccbe6f07ce7"),
    ("LGPL-2.1", "f998bc436710cfece156aaa84fd26dd4"),
    ("LGPL-3.0", "b31b7335bc37919e8cdd79154e04d88d"),
    ("MPL-1.1", "42f9588dde2c7c886167ed6c55291512"),
    ("MPL-2.0", "2f018c9b67a6a22cd85e1ae54c67640f"),
)


def notices() -> list[tuple[str, str]]:
    """(licence, text) of one-line notices and SPDX lines."""
    made = [(name, phrase + called) for name, names in NAMES.items() for called in names for phrase in PHRASES]
    return made + identifiers()


def identifiers() -> list[tuple[str, str]]:
    """(licence, text) of SPDX lines."""
    spdx = [(name, name) for name in (*NAMES, "0BSD", "Zlib")]
    spdx += [(name, name + end) for name in NAMES if "GPL" in name for end in ("-only", "-or-later")]
    return [(name, f"SPDX-License-Identifier: {short}") for name, short in spdx]


def short_texts() -> list[tuple[str, str]]:
    """(licence, text) of BSD texts in their usual numberings, and the Unlicense."""
    texts = [("Unlicense", _UNLICENSE + f"<{scheme}://unlicense.org{end}>") for scheme in ("http", "https") for end in ("", "/")]
    for count in (2, 3):
        for title in ("", f"BSD {count}-Clause License\n"):
            for mark in ("", "{}. ", "({}) "):
                for who in ("HOLDER", "OWNER"):
                    points = [mark.format(i + 1) + x for i, x in enumerate(_BSD_CONDITIONS[:count])]
                    texts.append((f"BSD-{count}-Clause", title + "\n".join([_BSD_START, *points, _BSD_END.format(who=who)])))
    return texts


def table(spark: SparkSession) -> DataFrame:
    """license and digest of all known texts."""
    made = known_digests(spark, [*KNOWN, *notices(), *short_texts()])
    return made.union(spark.createDataFrame(list(LONG_TEXTS), "license string, digest string")).distinct()
