"""``python -m clicklens <input> ...``: the command in ``clicklens.cli``."""

import sys

from clicklens.cli import main

sys.exit(main())
