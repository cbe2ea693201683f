"""``python -m ordermart <step> ...`` -- same as ``ordermart/cli.py``."""

import sys

from ordermart.cli import main

sys.exit(main())
