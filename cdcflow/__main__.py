from cdcflow.cli import main

main()
