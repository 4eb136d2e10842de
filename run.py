"""Entry point for spark-submit; see ``tillmark.cli``."""

from tillmark.cli import main

if __name__ == "__main__":
    main()
