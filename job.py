"""File for spark-submit; see clickpath.__main__ for the arguments."""

from clickpath.__main__ import main

if __name__ == "__main__":
    main()
