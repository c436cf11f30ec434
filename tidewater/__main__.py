import sys

from tidewater.plans.cli import main

sys.exit(main())
