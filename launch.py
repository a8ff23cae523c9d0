"""Entry script for ``spark-submit``: the same commands as ``python -m sentiflow``."""

from sentiflow.__main__ import main

if __name__ == "__main__":
    main()
