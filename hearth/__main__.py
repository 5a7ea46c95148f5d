"""``python -m hearth …`` runs the batch job (see ``hearth.plans.run``)."""

import sys

from hearth.plans.run import main

sys.exit(main())
