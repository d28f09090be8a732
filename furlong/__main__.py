"""``python -m furlong``."""

import sys

from furlong.commands import main

sys.exit(main(sys.argv[1:]))
