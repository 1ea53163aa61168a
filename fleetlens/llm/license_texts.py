"""Short notices by which licence families are announced, written for training and comparison.

Fixed values: the wording of each notice is the licence's own.  {holder} and {year}
are filled in at random while training.
"""

FAMILIES: dict[str, list[str]] = {
    "MIT": [
        "Released under the MIT License.",
        "This project is licensed under the MIT License, see the LICENSE file for details.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License.",
        "SPDX-License-Identifier: Apache-2.0",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "Released under the GNU General Public License version 2.",
    ],
    "LGPL": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation.",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ],
    "AGPL": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "This program is free software under the terms of the GNU Affero General Public License.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "CC-BY": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "CC-BY-SA": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC-SA 4.0.",
    ],
    "CC0": [
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "Released under CC0 1.0 Universal, public domain dedication.",
        "This is free and unencumbered software released into the public domain.",
    ],
    "proprietary": [
        "All rights reserved.",
        "Copyright {year} {holder}. All rights reserved.",
        "No part of this publication may be reproduced without the prior written permission of the publisher.",
    ],
}
