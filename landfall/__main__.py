import sys

from landfall.cli import main

main(sys.argv[1:])
