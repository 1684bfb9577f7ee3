from edgeframe.cli import main

main()
