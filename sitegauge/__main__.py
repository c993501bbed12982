"""``python -m sitegauge ...`` runs the jobs command line."""

from sitegauge.jobs import main

main()
