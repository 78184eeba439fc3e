from linkmill.llm import licenses
from linkmill.llm.licenses import scan_licenses

MIT = """ * Permission is hereby granted, free of charge, to any person obtaining a copy of this
 * software and associated documentation files (the "Software"), to deal in the Software without
 * restriction, including without limitation the rights to use, copy, modify, merge, publish,
 * distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
 * Software is furnished to do so, subject to the following conditions:
 *
 * The above copyright notice and this permission notice shall be included in all copies or
 * substantial portions of the Software."""
CASES = [
    (1, "That it\nLicensed under CC BY-NC 4.0.\nMore."),
    (2, MIT),
    (3, "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. x"),
    (4, "All rights reserved. Words. ALL  RIGHTS\tRESERVED!"),
    (5, "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: x"),
    (6, None),
    (7, ""),
    (8, "a licensed word and nothing known"),
    (9, "Released under the MIT License." + " x" * 300_000 + ". This work is licensed under the GNU General Public License, version 3."),
    (1, "That it\nLicensed under CC BY-NC 4.0.\nMore."),
]


def test_sentences_and_rules(spark, tmp_path):
    docs = spark.createDataFrame(CASES, "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    rows = {r.doc_id: r for r in scan_licenses(docs).collect()}
    assert rows[1].licenses == ["CC-BY-NC-4.0"]
    assert rows[2].license_sentences == ["MitGrant", "MitNotice"] and rows[2].licenses == ["MIT"] and rows[2].unruled == []
    assert rows[3].licenses == ["Apache-2.0"] and rows[3].license_sentences == ["Apache2Pre", "Apache2Comply"]
    assert rows[4].license_sentences == ["Reserved", "Reserved"] and rows[4].licenses == ["Proprietary"]
    assert rows[5].licenses == [] and rows[5].unruled == ["BsdPre"]
    assert all(rows[i].licenses == rows[i].license_sentences == rows[i].unruled == [] for i in (6, 7, 8))
    assert rows[9].licenses == ["GPL-3.0-only", "MIT"]
    import duckdb

    con = duckdb.connect()
    con.execute("create table documents(doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", [c for i, c in enumerate(CASES) if i < len(CASES) - 1])
    got = licenses.op3_license_scan(spark, str(tmp_path)).collect()
    assert len(got) == len(CASES)
    assert sorted(con.execute(licenses.ORACLE).fetchall()) == sorted({tuple(r) for r in got})


def test_clashing_columns_and_empty_table(spark):
    docs = spark.createDataFrame([("k", "All rights reserved.")], "licenses string, text string")
    assert scan_licenses(docs).collect()[0].licenses == ["Proprietary"]
    assert scan_licenses(docs.limit(0)).count() == 0
    own = scan_licenses(docs, sentences={"a b": "X"}, rules=[("N", ["X"])]).collect()[0]
    assert own.licenses == []


def test_every_known_sentence_has_an_anchor():
    words = licenses.anchors(licenses.SENTENCES)
    assert words and all(any(w in s for w in words) for s in licenses.SENTENCES)


COPYRIGHT = "Copyright (c) 2020 Jane Doe"
AS_IS = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS BE LIABLE."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
GPL = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation{} either version {} of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful.
"""
APACHE = """   Licensed under the Apache License, Version 2.0 (the "License");
   you may not use this file except in compliance with the License.
   You may obtain a copy of the License at

       http://www.apache.org/licenses/LICENSE-2.0

   Unless required by applicable law or agreed to in writing, software"""
WHOLE = [
    (f"MIT License\n\n{COPYRIGHT}\n\n{MIT.replace(' * ', '').replace(' *', '')}\n\n{AS_IS}\n", ["MitGrant", "MitNotice", "MitAsIs"], ["MIT"]),
    (f"/*\n * {COPYRIGHT}\n *\n{MIT}\n */", ["MitGrant", "MitNotice"], ["MIT"]),
    (f"{COPYRIGHT}\n{MIT}", ["MitGrant", "MitNotice"], ["MIT"]),
    (f"BSD 2-Clause License\n\n{COPYRIGHT}\n\n{BSD}", ["BsdPre", "BsdSource", "BsdBinary"], ["BSD-2-Clause"]),
    (f"demo\n{COPYRIGHT}\n\n{GPL.format(',', 3)}", ["GplFree", "GplTerms", "Gpl3Plus"], ["GPL-3.0-or-later"]),
    (GPL.format(";", 2), ["GplFree", "GplTerms", "Gpl2Plus"], ["GPL-2.0-or-later"]),
    (f"   {COPYRIGHT}\n\n{APACHE}", ["Apache2Pre", "Apache2Comply", "Apache2Copy"], ["Apache-2.0"]),
]


def test_whole_licence_files_with_their_copyright_lines(spark):
    docs = spark.createDataFrame([(n, text) for n, (text, _, _) in enumerate(WHOLE)], "doc_id long, text string")
    rows = {r.doc_id: r for r in scan_licenses(docs).collect()}
    for n, (_, ids, names) in enumerate(WHOLE):
        assert (rows[n].license_sentences, rows[n].licenses, rows[n].unruled) == (ids, names, [])


def test_both_readings_hold_at_their_places_of_one_text(spark):
    one_line = "Released under the MIT License\nwords that end nothing\n"
    wrapped = "# This work is licensed under the GNU General\n# Public License, version 3.\n"
    docs = spark.createDataFrame([(1, one_line + wrapped), (2, wrapped + one_line), (3, one_line + BSD)], "doc_id long, text string")
    rows = {r.doc_id: r for r in scan_licenses(docs).collect()}
    assert rows[1].license_sentences == ["MitRef", "Gpl3Ref"] and rows[2].license_sentences == ["Gpl3Ref", "MitRef"]
    assert rows[3].license_sentences == ["MitRef", "BsdPre", "BsdSource", "BsdBinary"] and rows[3].licenses == ["BSD-2-Clause", "MIT"]


NAMES = """Neither the name of the copyright holder nor the names of its
contributors may be used to endorse or promote products derived from
this software without specific prior written permission.
"""
OTHERS = [
    (f"BSD 3-Clause License\n\n{COPYRIGHT}\nAll rights reserved.\n\n{BSD}\n3. {NAMES}", ["BSD-3-Clause"]),
    (f"{COPYRIGHT}\nAll rights reserved.\n\n{BSD}", ["BSD-2-Clause"]),
    (f"# {COPYRIGHT}. All rights reserved.\n#\n# " + BSD.replace("\n", "\n# "), ["BSD-2-Clause"]),
    (f"{COPYRIGHT}\nAll rights reserved.\n", ["Proprietary"]),
    (f"ISC License\n\n{COPYRIGHT}\n\nPermission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\n"
     "copyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH\nREGARD TO THIS SOFTWARE"
     " INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY\nAND FITNESS. IN NO EVENT", ["ISC"]),
    ("/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not distributed with this\n"
     " * file, You can obtain one at http://mozilla.org/MPL/2.0/. */", ["MPL-2.0"]),
    ("This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\nLicense as published by the Free Software"
     " Foundation; either\nversion 2.1 of the License, or (at your option) any later version.\n", ["LGPL-2.1-or-later"]),
    (GPL.format(",", 3).replace("GNU General", "GNU Affero General"), ["AGPL-3.0-or-later"]),
    ("This is free and unencumbered software released into the public domain.\n\nAnyone is free", ["Unlicense"]),
    ("Permission is granted to anyone to use this software for any purpose,\nincluding commercial applications, and to alter it and redistribute it\nfreely, subject to the following"
     " restrictions:\n\n1. The origin", ["Zlib"]),
    ("This program and the accompanying materials are made available under the\nterms of the Eclipse Public License 2.0 which is available at\nhttps://www.eclipse.org/legal/epl-2.0/.\n", ["EPL-2.0"]),
    ("// SPDX-License-Identifier: MIT\nint x;", ["MIT"]),
    ("# spdx-license-identifier: GPL-2.0-or-later\n", ["GPL-2.0-or-later"]),
    ("This project is licensed under the MIT License.", ["MIT"]),
    ("Intro\nReleased under the MIT License, see LICENSE.\n", ["MIT"]),
    ("Licensed under the Apache License, Version 2.0.", ["Apache-2.0"]),
    ("License: https://opensource.org/licenses/MIT", ["MIT"]),
    ("See:\nhttp://creativecommons.org/licenses/by-sa/4.0/\n", ["CC-BY-SA-4.0"]),
    ("All rights reserved. This project is licensed under the MIT License.", ["MIT"]),
    ("The MIT License is a licence; this text has none.", []),
]


def test_further_licences_give_only_their_own_name(spark):
    docs = spark.createDataFrame([(n, text) for n, (text, _) in enumerate(OTHERS)], "doc_id long, text string")
    rows = {r.doc_id: r.licenses for r in scan_licenses(docs).collect()}
    assert [rows[n] for n in range(len(OTHERS))] == [names for _, names in OTHERS]


def test_the_sql_is_the_same_operator(spark, tmp_path):
    import duckdb

    texts = [t for t, _, _ in WHOLE] + [t for t, _ in OTHERS] + [t for _, t in CASES if t and len(t) < 10_000]
    texts += ["\n\n".join(texts), " ".join(texts), "".join(texts), "\n".join(f"# {t}" for t in texts), None, "", "licensed"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted(con.execute(licenses.ORACLE).fetchall()) == sorted(map(tuple, licenses.op3_license_scan(spark, str(tmp_path)).collect()))
