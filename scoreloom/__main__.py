"""python -m scoreloom"""

from .cli import main

main()
