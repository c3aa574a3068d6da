"""``python -m gasledger <command> ...`` runs the command-line jobs."""

import sys

from gasledger.jobs import main

main(sys.argv[1:])
