"""`python -m reviewflow <job> ...`; with spark-submit, name this file."""

from reviewflow.plans.jobs import main

if __name__ == "__main__":
    main()
