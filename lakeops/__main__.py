import sys

from lakeops.cli import main

sys.exit(main())
