"""Notices as they stand in files, and clauses that make no licence."""

import itertools
import random
import re
import textwrap

import pytest

from folioscope.llm import licences

FREE = "This {} is free software{} you can redistribute it and/or modify it under the terms of the GNU {} Public License"
FSF = " as published by the Free Software Foundation"
NOTICES = {
    "LGPL-2.1-or-later": FREE.format("library", ";", "Lesser General") + FSF + "; either version 2.1 of the License, "
    "or (at your option) any later version.",
    "LGPL-3.0-or-later": FREE.format("program", ":", "Lesser General") + FSF + ", either version 3 of the License, "
    "or (at your option) any later version.",
    "AGPL-3.0-or-later": FREE.format("program", ":", "Affero General") + FSF + ", either version 3 of the License, "
    "or (at your option) any later version.",
    "GPL-2.0-only": FREE.format("program", ";", "General") + " version 2" + FSF + ".",
    "GPL-3.0-or-later": FREE.format("program", ":", "General") + FSF + ", either version 3 of the License, or (at "
    "your option) any later version.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors "
    "be held liable for any damages arising from the use of this software.\n\nPermission is granted to anyone to use "
    "this software for any purpose, including commercial applications, and to alter it and redistribute it freely, "
    "subject to the following restrictions:\n\n1. The origin of this software must not be misrepresented; you must not "
    "claim that you wrote the original software.",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public "
    "License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
    "MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt)",
    "CC0-1.0": "To the extent possible under law, the author(s) have dedicated all copyright and related and "
    "neighboring rights to this software to the public domain worldwide.",
    "MIT OR Apache-2.0": "This crate is dual licensed under the MIT License or the Apache License, Version 2.0.",
    "Apache-2.0 OR MIT": "Licensed under either of Apache License, Version 2.0 or MIT license at your option.",
}
KNOWN = licences.compiled()


def scan(text):
    found = licences.sentences(text, KNOWN)
    return licences.ruled([name for _, _, name in found], licences.unknown(text, found))


@pytest.mark.parametrize("licence", NOTICES)
@pytest.mark.parametrize("lead", ["", " * ", "# "])
def test_notices_wrapped_and_unwrapped(licence, lead):
    text = NOTICES[licence]
    assert scan(text) == [licence]
    wrapped = "\n\n".join(textwrap.fill(part, 72) for part in text.split("\n\n"))
    assert scan(re.sub("^", lead, wrapped, flags=re.M)) == [licence]
    assert scan("Some words.\n" + text + "\nOther words.") == [licence]


def test_version_two_of_the_licence_only():
    assert scan(FREE.format("program", ";", "General") + FSF + "; version 2 of the License.") == ["GPL-2.0-only"]


def test_scattered_clauses_make_no_licence():
    grant = (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:"
    )
    binary = "Redistributions in binary form must reproduce the above copyright notice."
    isc = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."
    assert scan(f"{grant} one. {binary}") == ["BSD-2-Clause"]
    assert scan(f"{grant} Released under the MIT License. {isc} {'word ' * 50}. {binary}") == ["MIT", "ISC"]
    assert scan(f"{grant} {'An unknown sentence. ' * 4}{binary}") == ["BSD-2-Clause"]
    assert scan(f"{grant} {'An unknown sentence. ' * 5}{binary}") == []
    assert scan(f"{grant} {'word ' * 400}{binary}") == []


def plain(names, before):
    """Rules by trying every place for every rule, longest first, over identifiers without RESERVED."""
    kept, gap = [], 0
    for place, (name, count) in enumerate(zip(names, before)):
        gap += count
        if name != "RESERVED":
            kept.append([place, name, gap])
            gap = 0
    found = [(place, "all-rights-reserved") for place, name in enumerate(names) if name == "RESERVED"]
    for size in (3, 2, 1):
        for licence, needed in [rule for rule in licences.RULES if len(rule[1]) == size]:
            for at in range(len(kept)):
                some = kept[at : at + size]
                if tuple(x[1] for x in some) == needed and all(x[2] <= 4 for x in some[1:]):
                    found.append((some[0][0], licence))
                    for x in some:
                        x[1] = None
    return list(dict.fromkeys(licence for _, licence in sorted(found)))


def test_rules_against_plain_matching():
    rng = random.Random(5)
    names = sorted(set(itertools.chain(*(needed for _, needed in licences.RULES))))
    for _ in range(3000):
        pool = rng.sample(names, 5) + ["BSD_GRANT", "BSD_BINARY", "BSD_NAMES", "MIT_GRANT", "MIT_NOTICE", "RESERVED"]
        some = rng.choices(pool, k=rng.randrange(9))
        before = [rng.choice([0, 0, 1, 3, 4, 5]) for _ in some]
        assert licences.ruled(some, before) == plain(some, before), (some, before)
