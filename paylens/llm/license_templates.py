"""Notices and identifiers of common licences, as the public SPDX licence list gives their texts.

Only the words count: case, punctuation and line breaks do not. Names, years and holders are left out.
"""

from __future__ import annotations

# Fixed values: (label, words of the notice or of the part that tells the licence apart).
NOTICES = [
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of "
     "conditions and the following disclaimer."),
    ("bsd", "Redistributions in binary form must reproduce the above copyright notice, this list of "
     "conditions and the following disclaimer in the documentation and/or other materials provided "
     "with the distribution."),
    ("bsd-3-clause", "Neither the name of the copyright holder nor the names of its contributors may "
     "be used to endorse or promote products derived from this software without specific prior "
     "written permission."),
    ("boost", "Permission is hereby granted, free of charge, to any person or organization obtaining "
     "a copy of the software and accompanying documentation covered by this license (the "
     '"Software") to use, reproduce, display, distribute, execute, and transmit the Software'),
    ("boost", "Distributed under the Boost Software License, Version 1.0."),
    ("agpl-3.0", "This program is free software: you can redistribute it and/or modify it under the "
     "terms of the GNU Affero General Public License as published by the Free Software Foundation, "
     "either version 3 of the License, or (at your option) any later version."),
    ("agpl-3.0", "GNU Affero General Public License Version 3"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms "
     "of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("epl-2.0", "This program and the accompanying materials are made available under the terms of "
     "the Eclipse Public License 2.0 which is available at"),
    ("epl-2.0", "Eclipse Public License v 2.0"),
    ("cc0", "To the extent possible under law, the author(s) have dedicated all copyright and related "
     "and neighboring rights to this software to the public domain worldwide."),
    ("cc0", "CC0 1.0 Universal"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
     "International License."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
     "International License."),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event "
     "will the authors be held liable for any damages arising from the use of this software."),
    ("wtfpl", "Do What The Fuck You Want To Public License"),
    ("ofl-1.1", "This Font Software is licensed under the SIL Open Font License, Version 1.1."),
    ("cddl-1.0", "The contents of this file are subject to the terms of the Common Development and "
     "Distribution License"),
    ("eupl-1.2", "Licensed under the European Union Public Licence, Version 1.2"),
    ("artistic-2.0", "The Artistic License 2.0"),
]

# SPDX identifiers and their labels.
IDENTIFIERS = {
    "MIT": "mit",
    "Apache-2.0": "apache-2.0",
    "BSD-2-Clause": "bsd",
    "BSD-3-Clause": "bsd-3-clause",
    "BSL-1.0": "boost",
    "ISC": "isc",
    "Zlib": "zlib",
    "Unlicense": "unlicense",
    "MPL-2.0": "mpl-2.0",
    "EPL-2.0": "epl-2.0",
    "CDDL-1.0": "cddl-1.0",
    "EUPL-1.2": "eupl-1.2",
    "Artistic-2.0": "artistic-2.0",
    "OFL-1.1": "ofl-1.1",
    "WTFPL": "wtfpl",
    "CC0-1.0": "cc0",
    "CC-BY-4.0": "cc-by",
    "CC-BY-SA-4.0": "cc-by-sa",
    "CC-BY-NC-4.0": "cc-by-nc",
    "GPL-2.0": "gpl-2.0",
    "GPL-3.0": "gpl-3.0",
    "LGPL-2.1": "lgpl",
    "LGPL-3.0": "lgpl",
    "AGPL-3.0": "agpl-3.0",
}
TAG = "SPDX-License-Identifier"
