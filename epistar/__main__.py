"""``python -m epistar``: the command-line run (see ``epistar.cli``)."""

from epistar.cli import main

main()
